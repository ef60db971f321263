"""Mixing sources to target shares of all tokens, each text at most a capped number of times.

The total of a mix is the largest that every source can supply: its tokens times its cap over its share. A source
whose budget is more than once its tokens is taken whole so many times; for what remains, the texts below a threshold
of their hash are taken once more. Thresholds come from histograms: tokens are summed by source and bucket of the
hash, the bucket in which the budget is reached is the only one that is refined, level by level, until it holds one
text; then the texts are filtered. Nothing is sorted, and a smaller budget of a source draws a subset of a larger one.

Shape of the job: tokens are counted once and written once, as four narrow columns. Each level is one aggregation
with map-side combining over the texts of the boundary buckets, found by a broadcast join with the table of open budgets;
the running sums over a source's buckets are a window of at most ``BUCKETS`` rows. Histograms stay in Spark: what comes
to the driver and is broadcast is one row per mix and source, at most ``MAX_TARGETS``.

Defined results: texts of no source of a mix, null sources among them, are not drawn; nor are texts without tokens; a
source of the mix without tokens reaches a share of zero and doesn't hold the others down; targets that are null, zero
or less, and caps below one, are left out; the shares reached differ from the targets by less than a text per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestrata.lineage import cut
from lodestrata.llm.tokens import VOCABULARY, sized

BUCKET_BITS, LEVELS = 10, 6
BUCKETS = 1 << BUCKET_BITS
MAX_TARGETS = 100_000


def draw_hash(id_col: Column) -> Column:
    """A 60-bit hash of an id, uniform, as a long."""
    return F.shiftrightunsigned(F.xxhash64(F.lit("draw"), id_col), 4)


def _bucket(level: int) -> Column:
    return F.shiftrightunsigned(F.col("h"), BUCKET_BITS * (LEVELS - 1 - level))


def budgets(sizes: dict[str, int], targets: list[tuple[int, str, float, int]]) -> dict[tuple[int, str], float]:
    """Tokens to draw of each (mix, source): the largest mixes that the caps allow."""
    total: dict[int, float] = {}
    for mix, source, share, cap in targets:
        if sizes.get(source, 0) > 0:
            total[mix] = min(total.get(mix, float("inf")), cap * sizes[source] / share)
    return {(mix, source): total[mix] * share if sizes.get(source, 0) > 0 else 0.0 for mix, source, share, cap in targets if mix in total}


_OPEN = "mix_id int, source string, whole int, left double, prefix bigint"


def _boundaries(hist: DataFrame, need: DataFrame) -> list:
    """For each open budget the bucket in which it is reached: its number, its texts, its tokens and what is left to draw
    from it; nulls where the budget takes the whole range. ``hist``: source, prefix, b, n (tokens), k (texts)."""
    w = Window.partitionBy("source", "prefix").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    placed = hist.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0)))
    reached = (F.col("left") >= F.col("before")) & (F.col("left") < F.col("before") + F.col("n"))
    hit = placed.join(F.broadcast(need), ["source", "prefix"]).filter(reached)
    return hit.select("mix_id", "source", "whole", "b", "k", "n", (F.col("left") - F.col("before")).alias("left")).collect()


def thresholds(docs: DataFrame, targets: list[tuple[int, str, float, int]]) -> list[tuple[int, str, int, int]]:
    """(mix, source, whole repeats, bound): texts whose hash is below the bound are drawn once more."""
    spark = docs.sparkSession
    if not targets:
        return []
    wanted = spark.createDataFrame([(s,) for s in sorted({s for _, s, _, _ in targets})], "source string")
    sums = [F.sum("n_tokens").alias("n"), F.count(F.lit(1)).alias("k")]
    hist = cut(docs.join(F.broadcast(wanted), "source").groupBy("source", F.lit(0).cast("bigint").alias("prefix"), _bucket(0).alias("b")).agg(*sums))
    sizes = {r["source"]: r["n"] for r in hist.groupBy("source").agg(F.sum("n").alias("n")).collect()}
    out: dict[tuple[int, str], tuple[int, int]] = {}
    need = []
    for (mix, source), budget in budgets(sizes, targets).items():
        whole = int(budget // sizes[source] + 1e-9) if sizes.get(source) else 0
        if sizes.get(source):
            need.append((mix, source, whole, budget - whole * sizes[source], 0))
        else:
            out[mix, source] = (0, 0)
    for level in range(LEVELS):
        if not need:
            break
        shift = BUCKET_BITS * (LEVELS - 1 - level)
        if level:
            edges = spark.createDataFrame(sorted({(s, p) for _, s, _, _, p in need}), "source string, prefix bigint")
            inside = docs.withColumn("prefix", _bucket(level - 1)).join(F.broadcast(edges), ["source", "prefix"])
            hist = cut(inside.groupBy("source", "prefix", _bucket(level).alias("b")).agg(*sums))
        found = {(r["mix_id"], r["source"]): r for r in _boundaries(hist, spark.createDataFrame(need, _OPEN))}
        onward = []
        for mix, source, whole, left, prefix in need:
            r = found.get((mix, source))
            if r is None:
                out[mix, source] = (whole, prefix + 1 << BUCKET_BITS * (LEVELS - level))
            elif r["k"] == 1 or level == LEVELS - 1:
                out[mix, source] = (whole, (r["b"] + (r["left"] * 2 >= r["n"])) << shift)
            else:
                onward.append((mix, source, whole, r["left"], r["b"]))
        need = onward
    return [(mix, source, whole, bound) for (mix, source), (whole, bound) in sorted(out.items())]


def targets_of(table: DataFrame) -> list[tuple[int, str, float, int]]:
    """(mix_id, source, target_share, max_repeats) of a table of at most ``MAX_TARGETS`` rows."""
    good = table.filter("mix_id is not null and source is not null and target_share > 0 and max_repeats >= 1")
    rows = good.select("mix_id", "source", "target_share", "max_repeats").limit(MAX_TARGETS + 1).collect()
    if len(rows) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} targets")
    return [(int(r[0]), r[1], float(r[2]), int(r[3])) for r in rows]


def mix(docs: DataFrame, id_col: str, text_col: str, source_col: str, targets: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``mix_id``, ``doc_id``, ``source``, ``n_repeats``, ``n_tokens`` of every text drawn."""
    own = sized(docs, id_col, text_col, [source_col], vocabulary, project=False).filter("n_tokens > 0")
    measured = cut(own.select("doc_id", F.col(source_col).alias("source"), "n_tokens", draw_hash(F.col("doc_id")).alias("h")))
    bounds = thresholds(measured, targets_of(targets))
    spark = docs.sparkSession
    limits = spark.createDataFrame(bounds, "mix_id int, source string, whole int, bound bigint")
    drawn = measured.join(F.broadcast(limits), "source").withColumn("n_repeats", F.col("whole") + (F.col("h") < F.col("bound")).cast("int"))
    return drawn.filter("n_repeats > 0").select("mix_id", "doc_id", "source", "n_repeats", "n_tokens")


def share_report(drawn: DataFrame, targets: DataFrame) -> DataFrame:
    """Per mix and source: the target share, the share reached, tokens, texts and the most repeats of one text."""
    own = drawn.groupBy("mix_id", "source").agg(
        F.sum(F.col("n_tokens") * F.col("n_repeats")).alias("tokens"), F.count(F.lit(1)).alias("texts"), F.max("n_repeats").alias("most_repeats")
    )
    total = own.groupBy("mix_id").agg(F.sum("tokens").alias("mix_tokens"))
    return targets.join(own, ["mix_id", "source"], "left").join(total, "mix_id", "left").select(
        "mix_id", "source", "target_share", "max_repeats", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("texts", F.lit(0)).alias("texts"),
        F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), F.round(F.coalesce(F.col("tokens") / F.col("mix_tokens"), F.lit(0.0)), 6).alias("actual_share"),
    )
