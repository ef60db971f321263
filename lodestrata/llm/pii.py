"""Personal data in running text: finding it, and replacing it by typed placeholders or by surrogates.

Five types are found: email, phone, id_number, address, name. Numbers and signs anchor the first four: a fast scan
finds digits and at-signs, and only their surroundings are matched against the formats of ten languages. Names are
found in two ways: directly after a title or label of a person, whatever the words; and without one through words that
the corpus itself shows to be given and family names: those that follow such labels, ``MIN_SEEN`` times at least in all
documents.

Surrogates: an item is made of units (the words of a name or street, a number, the local part and the domain of an
address), and every unit gets a keyed replacement that depends on the key and the unit alone. So the same person, number
or address gets the same surrogate wherever it stands and however it is written (coreference): ``ROSSI Anna``, ``Anna
Rossi``, ``Rossi`` and ``A. Rossi`` go together, as a name begins with the keyed image of its first letter; ``+39 02..``
and ``003902..`` are one number, its digits drawn for the number and not for the spelling. A surrogate keeps its type,
its script, the gender that titles before the given name show in the corpus, and its format: capitals, separators, number
of digits, country code, top-level domain. No two units share a surrogate and none equals a unit that is real: the table
of distinct units is checked for both and those that fail are drawn again until none are left; the spellings written are
checked once more, by entity.

Shape of the job: two narrow passes over the texts, without shuffling them. The ``MAX_NAME_WORDS`` name words seen most
often are broadcast, the bound of what comes to the driver. Where a corpus has more, all others count as well: the
capitalised words of the texts are joined to them, salted, and each text gets those that stand in it; only then are the
texts written once and joined by row. The items found are written once; surrogates are made for their distinct spellings
and joined back, hot ones by a broadcast. Only ``surrogates`` joins the texts, by id and hash.

Defined results: a null or empty text has no entities and comes out unchanged; a text of any length is read whole, and
nothing is looked for in a window of fixed size; rows may repeat or lack an id;
where findings overlap the earlier and then the longer one counts, in the order email, phone, id_number, address, name.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestrata.lineage import cut
from lodestrata.skew import salted_join

TYPES = ("email", "phone", "id_number", "address", "name")
#: Name words broadcast at most, those seen most often; rarer ones reach the texts by a join.
MAX_NAME_WORDS = 1 << 17
#: A word is a name where no label stands before it from this many sightings after a title or label on.
MIN_SEEN = 2

#: Labels and titles that a person's name follows.
PERSON_LABELS = """whois: Admin-C: Ref. Rif. Referent: Contact: Sig. Sig.ra sig. sig.ra signor signora dott. dott.ssa Dott. Dott.ssa ing. avv. prof. prof.ssa geom. arch.
Il_referente La_referente rivolgersi_a Firmato_da M. Mme Mlle MM. contacter Signé_par conseiller conseillère Me Herr Herrn Frau erteilt Gezeichnet Berater Beraterin Mr Mr. Mrs Mrs. Ms Ms. Miss contact officer
Signed_by D. Dña. D.ª don doña Sr. Sra. técnico técnica contacto_con contactar_con Firmado_por Sr Sra Sr.ª Assinado_por contactar técnico_ técnica_ p. pan pani Pan Pani panem panią panu Podpisano: udziela doradca
dhr. mevr. mw. de_heer heer mevrouw Ondertekend_door adviseur met herr fru Herr Fru kontakta Undertecknat Undertecknat_av handläggaren κ. κα κος κ.κ. κύριος κυρία κυρίου κυρίας Υπογραφή: Υπογράφει: πληροφορίες: σύμβουλος υπάλληλος""".split()
_UP = "A-ZÀ-ÖØ-ÞĄĆĘŁŃŚŹŻŒΆΈΉΊΌΎΏΑ-Ω"
_CAP = rf"[{_UP}][\w]+(?:['’][{_UP}]?\w+)?(?:-[{_UP}]\w+)?"
_AFTER_LABEL = re.compile(rf"(?:[ \xa0])((?:[{_UP}]\. )?{_CAP})[ \xa0]({_CAP})(?:[ \xa0]({_CAP}))?")
_AFTER_INITIAL = re.compile(rf"[ \xa0][{_UP}]\.[ \xa0]({_CAP})(?!\w|[-'’]\w|[ \xa0]{_CAP})")
_INITIAL = re.compile(rf"(?:(?<=[^\w])|^)[{_UP}]\.[ \xa0]?(?:[{_UP}]\.[ \xa0]?)?$")
_CAP_BEFORE = re.compile(rf"(?:^|(?<=[^\w@./'’-]))({_CAP})[ \xa0]$")
_NEXT = re.compile(rf"[ \xa0\n]({_CAP})")
_WORD_END = re.compile(r"\w*(?:['’]\w+)?(?:-\w+)?")
#: Those of them that tell a woman and a man.
WOMEN = frozenset("Sig.ra sig.ra signora dott.ssa Dott.ssa prof.ssa Mme Mlle conseillère Frau Beraterin Mrs Mrs. Ms Ms. Miss Dña. D.ª doña Sra. técnica Sra Sr.ª técnica_ pani Pani panią mevr. mw. mevrouw fru Fru κα κυρία κυρίας".split())
MEN = frozenset("Sig. sig. signor signore M. conseiller Herr Herrn Berater Mr Mr. D. don Sr. técnico Sr técnico_ pan Pan panem panu dhr. de_heer heer herr κ. κος κύριος κυρίου".split())
#: Capitalised words that begin sentences; never part of a name.
STARTERS = frozenset(
    "La Le Les Il Lo Gli L Un Una Une Der Die Das Ein Eine Den Dem The A An El Los Las O Os As De Het Een En I Den Det Η Ο Το Οι Τα Στο Στη Για Per Pour Para Für For Voor Dla På Con Mit With Med Από Con Nel Nella Dal Alla Au Aux Du Des Del Al Do Da Na No Em Im Am Beim Zum Zur In On At".split()
)
#: Institution words; a capitalised pair beside one is the institution's name.
INSTITUTION = re.compile(
    r"[ \xa0](?:Community|College|School|Institute|Library|Hospital|Centre|Center|Foundation|University|Academy|Gymnasium|Schule|Grundschule|Stiftung|Kommun|Skola|Lyceum|Liceo|Lycée|Liceum)\b"
)
_QUOTES = "«„“”‘’‚\"'‹›»"

_SIGN = re.compile(r"@|\[at\]|\[AT\]|\(at\)|\(AT\)| AT |&#64;|＠")
_DOT_SIGNS = tuple(f"{a}{sign}{b}" for sign in ("[dot]", "(dot)") for a in (" ", "") for b in (" ", "")) + (" DOT ",)
_DOMAIN = re.compile(r"[ \xa0]?[A-Za-z0-9](?:[\w-]*\w)?(?:(?:\.| ?\[dot\] ?| ?\(dot\) ?| DOT | dot )[A-Za-z0-9](?:[\w-]*\w)?)+", 0)

_DIGITS = re.compile(r"\d+")
_S = r"[ \xa0./-]"
_PHONE = re.compile(
    rf"\+\d{{1,3}}(?:[ \xa0]?\(0\)[ \xa0]?|{_S}?)\d{{1,4}}(?:{_S}?\d{{2,4}}){{1,4}}(?!\w)"
    rf"|00\d{{2,3}}{_S}\(?\d{{1,4}}\)?(?:{_S}?\d{{2,8}}){{1,4}}(?!\w)"
    rf"|\(0\d{{1,4}}\)[ \xa0]?\d{{2,4}}(?:{_S}?\d{{2,4}}){{1,3}}(?!\w)"
    rf"|0\d{{2,3}}(?:[-/. \xa0]\d{{3}}(?:[-. \xa0]?\d{{2}}[-. \xa0]?\d{{2}})|[-/. \xa0]\d{{6,7}})(?!\w)"
    rf"|0\d{{1,2}}(?:[. \xa0-]\d{{2}}){{4}}(?!\w)"
)
_LAST_GROUP = re.compile(r"[ \xa0./-]\d+$")
_ID = re.compile(
    r"[12] ?\d\d ?(?:0[1-9]|1[0-2]|[2-9]\d) ?(?:\d\d|2[AB]) ?\d{3} ?\d{3} ?\d\d(?!\w)"
    r"|(?:19|20)?\d\d(?:0[1-9]|1[0-2])(?:[0-2]\d|3[01])[-+]\d{4}(?!\w)"
    r"|\d{2}[.]\d{3}[.]\d{3} ?-? ?[A-Z](?!\w)|\d{8} ?-? ?[A-Z](?!\w)"
    r"|\d{7} ?[A-W][A-IW]?(?!\w)"
    r"|\d{4}\.\d\d\.\d{3}(?!\w)|\d\d[ \xa0]\d{3}[ \xa0]\d{3}[ \xa0]\d{3}(?!\w)|\d{3}[ \xa0.]\d{3}[ \xa0.]\d{3}(?!\w)"
    r"|\d{11}(?!\w)|\d{9}(?!\w)"
)
_GOES_ON = re.compile(r"[-./,:]\d|[ \xa0]?[€%]|[ \xa0]/[ \xa0]\d")
_FISCAL = re.compile(r"[A-Z]{3}[ \xa0]?[A-Z]{3}[ \xa0]?[\dLMNP-V]{2}[A-EHLMPRST][\dLMNP-V]{2}[ \xa0]?[A-Z][\dLMNP-V]{3}[A-Z](?!\w)", re.I)
_NIE = re.compile(r"[XYZ]-?\d{7}-?[A-Z](?!\w)")

#: Street types before the name, as written in ten languages.
STREET_TYPES = frozenset(
    """via viale v.le piazza p.zza p.za piazzale piazzetta largo corso c.so vicolo contrada lungomare strada salita località
calle c/ cl. avenida avda. avda av. paseo pº plaza pza. ronda camino carretera ctra. travesía glorieta
rua r. lg. travessa tv. praça pç. alameda estrada beco calçada
ul. ulica ulicy al. aleja alei os. osiedle plac pl. rynek
οδός οδού οδ. λεωφόρος λεωφόρου λεωφ. λ. πλατεία πλατείας πλ. πάροδος
rue avenue bd bd. boulevard chemin place impasse allée quai route str.""".split()
)
#: Endings of street names that hold their type, types set off from them, and words before them.
STREET_ENDINGS = tuple(
    """straße strasse str. weg allee platz gasse ring damm ufer steig stieg markt graben pfad
straat laan kade plein singel gracht dijk hof pad steeg dreef park gatan vägen gränd torget stigen backen allén leden väg gata""".split()
)
SPACED_TYPES = frozenset("straße str. weg allee platz gasse ring damm ufer".split())
STREET_ADJECTIVES = frozenset("am im alte alter neue neuer große kleine lange oude nieuwe gamla stora lilla norra södra västra östra".split())
#: Signs before a house number.
NUMBER_SIGNS = frozenset("n. n n° n.° n.º nº n.ª nr nr. no no. num. núm. número numero αρ. αριθ.".split())
_AFTER = re.compile(
    r"[a-z]?(?:[ \xa0](?:bis|ter|quater))?,?[ \xa0](?:[Rr]ue|[Aa]venue|[Aa]v\.|[Bb]d\.?|[Bb]oulevard|[Cc]hemin|[Cc]h\.|[Pp]lace|[Pp]l\.|[Ii]mpasse|[Aa]llée|[Qq]uai|[Rr]oute|[Cc]ours|[Ss]quare|[Rr]uelle|[Pp]assage|[Ss]entier|[Ff]aubourg)[ \xa0](?:(?:de|du|des|la|le|les)[ \xa0]|(?:de )?l['’]|d['’])*[^\W\d_][\w'’-]*(?:[ \xa0-][{U}][\w'’-]*){0,3}".replace("{U}", _UP)
    + r"|[a-z]?,?[ \xa0](?:[{U}][\w'’-]+[ \xa0]){1,3}?(?:Street|St\b\.?|Road|Rd\b\.?|Avenue|Ave\b\.?|Lane|Ln\b\.?|Square|Sq\b\.?|Terrace|Ter\b\.?|Tce\b\.?|Drive|Dr\b\.?|Court|Ct\b\.?|Close|Place|Way|Row|Crescent|Cres\b\.?|Quay|Parade|Walk|Mews|Gardens|Grove)(?!\w)".replace("{U}", _UP)
)
_HOUSE_TAIL = re.compile(r"(?:[ \xa0]?(?:bis|ter)\b|[a-z](?!\w)|[ \xa0]?/[ \xa0]?\w{1,3}(?!\w)|-\d{1,3}(?!\d)|[ \xa0][a-d](?!\w))?(?:,[ \xa0]\d{1,2}\.?[ºª°][ \xa0]?[a-z]?(?!\w))?")


@dataclass(frozen=True)
class Finding:
    start: int
    end: int
    kind: str


def _word_char(c: str) -> bool:
    return c.isalnum() or c == "_"


def _run_start(text: str, end: int) -> int | None:
    """Where the run of word characters and ``.+-`` that ends at ``end`` with a word character begins, or None."""
    if not end or not _word_char(text[end - 1]):
        return None
    at = end
    while at and (_word_char(text[at - 1]) or text[at - 1] in ".+-"):
        at -= 1
    return at


def _local_start(text: str, end: int) -> int | None:
    """Where the local part of an address whose sign begins at ``end`` begins, or None."""
    start = _run_start(text, end - 1 if end and text[end - 1] in " \xa0" else end)
    while start:
        sign = next((s for s in _DOT_SIGNS if text.endswith(s, 0, start)), None)
        before = _run_start(text, start - len(sign)) if sign else None
        if before is None:
            break
        start = before
    return start


def _emails(text: str) -> Iterator[Finding]:
    for m in _SIGN.finditer(text):
        domain = _DOMAIN.match(text, m.end())
        start = _local_start(text, m.start()) if domain else None
        if start is not None:
            yield Finding(start, domain.end(), "email")


def _numbers(text: str) -> Iterator[Finding]:
    done = -1
    for m in _DIGITS.finditer(text):
        a, b = m.span()
        if a < done:
            continue
        before = text[a - 1] if a else " "
        if before.isalnum():
            if a < 6 or not (text[a - 6 : a].isalpha() or text[a - 3 : a].isalpha() and text[a - 7 : a - 3].isupper()):
                if not (before.isupper() and before in "XYZ"):
                    continue
            f = next((f for s in (a - 6, a - 7, a - 8) if s >= 0 and (f := _FISCAL.match(text, s)) and not (s and (text[s - 1].isalnum() or text[s - 1] in "#_/"))), None)
            f = f or (_NIE.match(text, a - 1) if a < 2 or not text[a - 2].isalnum() else None)
            if f:
                done = f.end()
                yield Finding(f.start(), done, "id_number")
            continue
        if before in "#_/.=@-":
            continue
        if before in "+(" or text[a] == "0":
            s = a - 1 if before == "+" or before == "(" and text[a] == "0" else a
            p = None
            if not (s and (text[s - 1].isalnum() or text[s - 1] in "#_./-=@")):
                p = _PHONE.match(text, s) or (_PHONE.match(text, a) if s < a else None)
            if p:
                stop = p.end()
                while sum(c.isdigit() for c in text[p.start() : stop]) > (15 if p[0][:2] == "00" else 14) and (shorter := _LAST_GROUP.search(text, p.start(), stop)):
                    stop = shorter.start()
                if (11 if p[0][:2] == "00" else 8) <= sum(c.isdigit() for c in text[p.start() : stop]) <= 15:
                    done = stop
                    yield Finding(p.start(), done, "phone")
                    continue
        size = b - a
        if size <= 4:
            got = _address(text, a, b)
            if got:
                done = got.end
                yield got
                continue
        if before == " " and size <= 2 and a >= 8 and text[a - 2].isupper():
            f = _FISCAL.match(text, a - 8)
            if f and (a == 8 or not text[a - 9].isalnum()):
                done = f.end()
                yield Finding(f.start(), done, "id_number")
                continue
        if before in "+,":
            continue
        i = _ID.match(text, a)
        if i and not _GOES_ON.match(text, i.end()):
            done = i.end()
            yield Finding(a, done, "id_number")


def _address(text: str, a: int, b: int) -> Finding | None:
    """The address whose house number is text[a:b]."""
    if text[a - 1 : a] in (" ", "\xa0"):
        size = 90
        while True:
            left = text[max(0, a - size) : a - 1].replace("\xa0", " ")
            if size >= a or "\n" in left or left.count(" ") > 9:
                break
            size *= 4
        words = left[left.rfind("\n") + 1 :].split(" ")
        at = a - 1
        if words[-1].lower() in NUMBER_SIGNS:
            at -= len(words.pop()) + 1
        last = words[-1].rstrip(",") if words else ""
        start = None
        low = last.lower()
        if last[:1].isupper() and low.endswith(STREET_ENDINGS):
            start = at - len(words[-1])
            if len(words) > 1 and words[-2].lower() in STREET_ADJECTIVES:
                start -= len(words[-2]) + 1
        elif low in SPACED_TYPES and len(words) > 1 and words[-2][:1].isupper():
            start = at - len(words[-1]) - 1 - len(words[-2])
        elif last[:1].isalpha():
            at -= len(words[-1])
            named = last[:1].isupper()
            for word in reversed(words[-7:-1]):
                at -= len(word) + 1
                bare = word.lstrip("(«\"'[<>")
                if bare.lower() in STREET_TYPES:
                    start = at + len(word) - len(bare) if named else None
                    break
                if not word or word[0] in "(«\"[<" or _DIGITS.search(word) or word[-1] in ",;:)!?" or word[-1] == "." and len(word) > 3:
                    break
                named = named or word[:1].isupper() or word[:2].lower() in ("l'", "d'", "l’", "d’") and word[2:3].isupper()
        if start is not None:
            tail = _HOUSE_TAIL.match(text, b)
            return Finding(start, tail.end() if tail else b, "address")
    after = _AFTER.match(text, b)
    return Finding(a, after.end(), "address") if after else None


def _forms(words: set[str]) -> ahocorasick.Automaton:
    """Finds the spellings of words, each with its length."""
    out = ahocorasick.Automaton()
    for w in words:
        for form in {w.title(), w.upper(), w[:1].upper() + w[1:]}:
            out.add_word(form, len(form))
    if len(out):
        out.make_automaton()
    return out


class Names:
    """Finds persons' names by the words known as given and family names."""

    def __init__(self, given: dict[str, str] | set[str], family: set[str]) -> None:
        """``given``: words, as keys with ``f`` or ``m`` where titles tell the gender."""
        self.given, self.family = given if isinstance(given, dict) else dict.fromkeys(given, ""), family
        self.words = _forms(self.given.keys() | family)

    def gender(self, word: str) -> str:
        return self.given.get(word, "")

    def with_rare(self, given: dict[str, str], family: set[str]) -> Names:
        """These names and rarer words that stand in one text."""
        return _WithRare(self, given, family) if given or family else self

    def hits(self, text: str) -> Iterable[tuple[int, int]]:
        """(end, size) of the forms of known words, by end."""
        return self.words.iter(text) if len(self.words) else ()

    def is_given(self, word: str) -> bool:
        return word in self.given

    def is_family(self, word: str) -> bool:
        return word in self.family

    def _known(self, word: str) -> str | None:
        low = word.lower()
        if self.is_given(low):
            return "g"
        parts = low.split("-")
        if any(self.is_family(p) for p in parts) or self.is_family(low):
            return "f"
        return "g" if len(parts) > 1 and self.is_given(parts[0]) else None

    def find(self, text: str, taken: list[Finding]) -> Iterator[Finding]:
        done, t = -1, 0
        for end, size in self.hits(text):
            a = end - size + 1
            if a < done or a and (text[a - 1].isalnum() or text[a - 1] in "_@./-'’"):
                continue
            b = _WORD_END.match(text, a).end()
            first = text[a:b]
            kind = self._known(first)
            if kind is None or "_" in first or not first.replace("-", "").replace("’", "").replace("'", "").isalpha():
                continue
            while t < len(taken) and taken[t].end <= a:
                t += 1
            if t < len(taken) and taken[t].start < b:
                continue
            start, stop, kinds = a, b, [kind]
            left = text[max(0, a - 40) : a]
            initial = _INITIAL.search(left)
            if initial and kind == "f":
                parts = initial[0].split(".")
                titled = len(parts) > 2 and parts[0].strip() in ("D", "M")
                start, kinds = a - len(initial[0]) + (len(parts[0]) + 1 + (parts[1][:1] in " \xa0") if titled else 0), ["i", kind]
            elif kind == "g":
                size = 40
                while (word := _CAP_BEFORE.search(left)) and not word.start() and size < a:
                    size *= 4
                    left = text[max(0, a - size) : a]
                if word and word[1].isupper() and len(word[1]) > 2 and not first.isupper() and word[1] not in STARTERS and self._known(word[1]) != "g":
                    start, kinds = a - len(word[0]), ["f", kind]
            while len(kinds) < 4:
                n = _NEXT.match(text, stop)
                if not n or n[1] in STARTERS:
                    break
                k = self._known(n[1])
                if n[0][0] == "\n" and (k != "f" or "f" in kinds):
                    break
                if k is None:
                    if "g" not in kinds and "i" not in kinds or "f" in kinds or len(n[1]) < 3:
                        break
                    k = "f"
                if k == "f" and kinds[-1] == "f" or "f" in kinds and "g" in kinds:
                    break
                kinds.append(k)
                stop = n.end()
            if kinds[0] == "i" and "g" in kinds and initial[0].count(".") == 1:
                start, kinds = a, kinds[1:]
            if "f" not in kinds or not ({"g", "i"} & set(kinds)):
                if not (kinds == ["g", "g"] or kinds == ["g"] and re.match(rf"[ \xa0][{_UP}]\.(?!\w)", text[stop : stop + 4])):
                    continue
                if kinds == ["g"]:
                    stop += 3
            done = stop
            before, after = text[max(0, start - 2) : start].strip()[-1:], text[stop : stop + 2].strip()[:1]
            if before and after and before in _QUOTES and after in _QUOTES:
                continue
            if INSTITUTION.match(text, stop) or text[max(0, start - 4) : start] == "The ":
                continue
            if t < len(taken) and taken[t].start < stop:
                continue
            yield Finding(start, stop, "name")


class _WithRare(Names):
    """The names of a base, not copied, and some more."""

    def __init__(self, base: Names, given: dict[str, str], family: set[str]) -> None:
        super().__init__(given, family)
        self.base = base

    def gender(self, word: str) -> str:
        return self.given.get(word) or self.base.gender(word)

    def hits(self, text: str) -> Iterable[tuple[int, int]]:
        return sorted([*self.base.hits(text), *super().hits(text)])

    def is_given(self, word: str) -> bool:
        return word in self.given or word in self.base.given

    def is_family(self, word: str) -> bool:
        return word in self.family or word in self.base.family


def find(text: str | None, names: Names) -> list[Finding]:
    """All personal data in a text, by position, without overlaps."""
    if not text:
        return []
    taken = list(_emails(text))
    spans = [(f.start, f.end) for f in taken]
    for f in _numbers(text):
        if not any(s < f.end and f.start < e for s, e in spans):
            taken.append(f)
    taken.sort(key=lambda f: f.start)
    known = list(names.find(text, taken))
    return sorted([*taken, *_joined(known, labelled(text, names), taken)], key=lambda f: f.start)


def _joined(known: list[Finding], direct: Iterable[Finding], taken: list[Finding]) -> Iterator[Finding]:
    """Names by known words and names after labels; one that begins inside a name after a label is part of it."""
    left, k, t = list(known), 0, 0
    for f in direct:
        while k < len(left) and left[k].end <= f.start:
            yield left[k]
            k += 1
        while t < len(taken) and taken[t].end <= f.start:
            t += 1
        if t < len(taken) and taken[t].start < f.end or k < len(left) and left[k].start <= f.start:
            continue
        end = f.end
        while k < len(left) and left[k].start < end:
            end = max(end, left[k].end)
            k += 1
        yield Finding(f.start, end, "name")
    yield from left[k:]


_labels: ahocorasick.Automaton | None = None


def _label_automaton() -> ahocorasick.Automaton:
    global _labels
    if _labels is None:
        _labels = ahocorasick.Automaton()
        for label in PERSON_LABELS:
            shown = label.replace("_", " ").strip() + " "
            _labels.add_word(shown, (len(shown), "f" if label in WOMEN else "m" if label in MEN else ""))
        _labels.make_automaton()
    return _labels


def _after_labels(text: str) -> Iterator[tuple[re.Match, bool, str]]:
    """The name pattern after each label of a person, whether it is an initial with a family name, and the label's gender."""
    for end, (size, gender) in _label_automaton().iter(text):
        a = end - size + 1
        if a and (text[a - 1].isalnum() or text[a - 1] == "-"):
            continue
        alone = _AFTER_INITIAL.match(text, end)
        if alone and alone[1] not in STARTERS:
            yield alone, True, gender
            continue
        m = _AFTER_LABEL.match(text, end)
        if m and m[1] not in STARTERS and m[2] not in STARTERS and not INSTITUTION.match(text, m.end()):
            yield m, False, gender


def labelled(text: str, names: Names) -> Iterator[Finding]:
    """The names that stand directly after a label of a person, of words known or not.

    Two capitalised words, or three unless just one of the first two is a known family name; an initial before them is a title.
    """
    done = -1
    for m, alone, _ in _after_labels(text):
        start, stop = m.start() + 1, m.end(1)
        if not alone:
            start, stop = m.end(1) - len(m[1].split(" ")[-1]), m.end(2)
            first = text[start : m.end(1)]
            if first in STARTERS or INSTITUTION.match(text, stop):
                continue
            if m[3] and m[3] not in STARTERS and len(m[3]) > 2 and [names._known(first), names._known(m[2])].count("f") != 1:
                stop = m.end(3)
        if start < done or INSTITUTION.match(text, stop) or any(c.isdigit() or c == "_" for c in text[start:stop]):
            continue
        done = stop
        yield Finding(start, stop, "name")


def sightings(text: str) -> Iterator[tuple[str, str]]:
    """(role, word) of the words after labels of persons; roles are given, family, and f or m for a given name after a
    title that tells the gender."""
    for m, alone, gender in _after_labels(text):
        if alone:
            for part in m[1].lower().split("-"):
                yield "family", part
                yield "family", part
            continue
        x, y = m[1], m[2]
        if x.isupper() and not y.isupper():
            x, y = y, x
        if "." not in x:
            yield "given", x.lower()
            if gender:
                yield gender, x.lower()
        for part in y.lower().split("-"):
            yield "family", part


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter = Counter()
    for batch in batches:
        for text in batch["text"]:
            if text:
                total.update(sightings(text))
    yield pd.DataFrame([(r, w, n) for (r, w), n in total.items()], columns=["role", "word", "n"])


def learn_names(texts: DataFrame) -> tuple[dict[str, str], set[str], DataFrame | None]:
    """Given names with their gender and family names, seen after labels of persons in all texts of a column ``text``.

    The first two hold the ``MAX_NAME_WORDS`` words seen most often; the table holds all others (``word``, ``is_given``,
    ``gender``), and is null if there are none.
    """
    sums = [F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)).alias(r) for r in ("given", "family", "f", "m")]
    counted = texts.mapInPandas(_count, "role string, word string, n bigint").groupBy("word").agg(*sums)
    gender = F.when(F.col("f") > F.col("m"), "f").when(F.col("m") > F.col("f"), "m").otherwise("")
    learned = counted.filter(F.col("given") + F.col("family") >= MIN_SEEN).select("word", (F.col("given") + F.col("family")).alias("n"), (F.col("given") > F.col("family")).alias("is_given"), gender.alias("gender"))
    rows = learned.orderBy(F.desc("n"), "word").limit(MAX_NAME_WORDS + 1).collect()
    rare = None
    if len(rows) > MAX_NAME_WORDS:
        last = rows[MAX_NAME_WORDS - 1]
        rare = learned.filter((F.col("n") < last["n"]) | (F.col("n") == last["n"]) & (F.col("word") > last["word"])).select("word", "is_given", "gender")
        rows = rows[:MAX_NAME_WORDS]
    return {r["word"]: r["gender"] for r in rows if r["is_given"]}, {r["word"] for r in rows if not r["is_given"]}, rare


_TOKEN = re.compile(r"\w+(?:['’]\w+)?(?:-\w+)?")
_PIECE = re.compile(r"\w+")


def name_candidates(text: str | None) -> set[str]:
    """Every word, in lower case, that could be a name in this text if it were known."""
    out: set[str] = set()
    for m in _TOKEN.finditer(text or ""):
        if m[0][0].islower() or m[0][0].isdigit():
            continue
        low = m[0].lower()
        out.update((low, *low.split("-"), *_PIECE.findall(low)))
        if "-" in low:
            out.update(low[:n] for n in range(2, low.index("-")))
    return out


def _with_names(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, object]:
    """``doc_id``, ``text``, ``rare`` of every row, ``rare`` the rarer name words in the text, and the broadcast others."""
    texts = df.select(df[id_col].cast("bigint").alias("doc_id"), df[text_col].alias("text"))
    given, family, rare = learn_names(texts.select("text"))
    shared = df.sparkSession.sparkContext.broadcast((given, family))
    if rare is None:
        return texts.withColumn("rare", F.lit(None).cast(_RARE)), shared
    rows = cut(texts.withColumn("__row", F.monotonically_increasing_id()))

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = shared.value[0].keys() | shared.value[1]
        for batch in batches:
            pairs = [(r, w) for r, t in zip(batch["__row"], batch["text"], strict=True) for w in name_candidates(t) - common]
            yield pd.DataFrame(pairs, columns=["__row", "word"])

    there = salted_join(rows.select("__row", "text").mapInPandas(words, "__row bigint, word string"), rare, ["word"], "__row")
    by_row = there.groupBy("__row").agg(F.collect_list(F.struct("word", "is_given", "gender")).alias("rare"))
    return rows.join(by_row, "__row", "left").select("doc_id", "text", "rare"), shared


def _names_of(common: Names, rare: Iterable | None) -> Names:
    if rare is None:
        return common
    return common.with_rare({r["word"]: r["gender"] for r in rare if r["is_given"]}, {r["word"] for r in rare if not r["is_given"]})


_RARE = "array<struct<word:string,is_given:boolean,gender:string>>"
_LETTERS = re.compile(r"[^\W\d_]+")
_FOUND = "doc_id bigint, start int, end int, kind string, surface string"


def entities(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``start``, ``end``, ``kind``, ``surface`` of every item of personal data."""
    texts, shared = _with_names(df, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(*shared.value)
        for batch in batches:
            rows = [(d, f.start, f.end, f.kind, t[f.start : f.end]) for d, t, r in zip(batch["doc_id"], batch["text"], batch["rare"], strict=True) for f in find(t, _names_of(names, r))]
            yield pd.DataFrame(rows, columns=["doc_id", "start", "end", "kind", "surface"])

    return texts.mapInPandas(run, _FOUND)


#: What stands in a redacted text.
PLACEHOLDER = {k: f"[{k.upper()}]" for k in TYPES}


def redact(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``redacted``, ``n_found``: every text with a typed placeholder for each item."""
    texts, shared = _with_names(df, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(*shared.value)
        for batch in batches:
            rows = []
            for d, t, r in zip(batch["doc_id"], batch["text"], batch["rare"], strict=True):
                found = find(t, _names_of(names, r))
                rows.append((d, replaced(t, [(f.start, f.end, PLACEHOLDER[f.kind]) for f in found]), len(found)))
            yield pd.DataFrame(rows, columns=["doc_id", "redacted", "n_found"])

    return texts.mapInPandas(run, "doc_id bigint, redacted string, n_found int")


def replaced(text: str | None, parts: list[tuple[int, int, str]]) -> str | None:
    """The text with each (start, end) replaced."""
    if not text:
        return text
    out, at = [], 0
    for start, end, new in sorted(parts):
        out += [text[at:start], new]
        at = end
    return "".join(out) + text[at:]


# -- surrogates

#: Rounds of drawing before giving up; made words grow with the round.
MAX_ROUNDS = 24
_CONSONANTS, _VOWELS = {"latin": "bdfgklmnprstvz", "greek": "βγδζκλμνπρστφ"}, {"latin": "aeiou", "greek": "αειου"}
_ALPHABET = {"latin": "abcdefghijklmnopqrstuvwxyz", "greek": "αβγδεζηθικλμνξοπρστυφχψω"}
_GENDERED = {("f", "latin"): "a", ("m", "latin"): "o", ("f", "greek"): "α", ("m", "greek"): "ος"}
_GREEK = re.compile("[Ͱ-Ͽἀ-῿]")
_DOT = re.compile(r"( ?\[dot\] ?| ?\(dot\) ?| dot |\.)", re.I)
#: Words of streets after the name, and labels under which domains are registered.
_STREET_WORDS = frozenset("street st road rd avenue ave lane ln square sq terrace ter tce drive dr court ct close place way row crescent cres quay parade walk mews gardens grove bis quater".split())
_REGISTRY_LABELS = frozenset("co com gov org edu ac gob gouv net".split())
#: Country codes of one digit and of two; all others have three.
_ONE_DIGIT, _TWO_DIGITS = ("1", "7"), frozenset("20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _phone(surface: str) -> tuple[str, list[int]]:
    """A number's digits, after a plus if it is international, and where in the spelling they stand."""
    optional = surface.find("(0)")
    at = [i for i, c in enumerate(surface) if c.isdigit() and i != optional + 1] if optional >= 0 else [i for i, c in enumerate(surface) if c.isdigit()]
    digits = "".join(surface[i] for i in at)
    if surface.lstrip("( ")[:1] == "+":
        return "+" + digits, at
    return ("+" + digits[2:], at[2:]) if digits.startswith("00") else (digits, at)


def entity_key(kind: str, surface: str) -> str:
    """What makes two mentions one entity: digits of numbers, spelling-free e-mail, the set of a name's words."""
    low = surface.lower()
    if kind == "email":
        low = re.sub(r" ?(?:\[at\]|\(at\)|&#64;|＠| at ) ?| ?@ ?", "@", low)
        return re.sub(r" ?\[dot\] ?| ?\(dot\) ?| dot ", ".", low.replace("\xa0", " ")).strip()
    if kind == "phone":
        return _phone(surface)[0]
    if kind == "id_number":
        return "".join(c for c in low if c.isalnum())
    words = re.findall(r"[^\W_]+", low)
    return " ".join(sorted(words) if kind == "name" else words)


def _street_names(surface: str) -> list[str]:
    """The words of an address that name its street; kinds of streets, small words and numbers are left out."""
    words = [w for w in _LETTERS.findall(surface) if len(w) > 1]
    dotted = {m[1].lower() for m in re.finditer(r"([^\W\d_]+)\.", surface)}
    plain = [w for w in words if w.lower() not in STREET_TYPES and f"{w.lower()}." not in STREET_TYPES | NUMBER_SIGNS and w.lower() not in _STREET_WORDS and w.lower() not in NUMBER_SIGNS and w.lower() not in STREET_ENDINGS and w.lower() not in dotted]
    named = [w for w in plain if w[0].isupper() and len(w) > 3]
    return named or sorted(plain or words, key=len)[-1:]


def units(kind: str, surface: str, given: dict[str, str]) -> list[tuple[str, str, str]]:
    """(unit's kind, unit, hint) of an item: what gets a surrogate of its own. ``given`` holds the words of a name that are
    given names, with their gender."""
    if kind == "email":
        local, _, domain = entity_key(kind, surface).rpartition("@")
        return [("local", local, ""), ("domain", domain, "")]
    if kind in ("phone", "id_number"):
        return [(kind, entity_key(kind, surface), "")]
    if kind == "address":
        return [("street", w.lower(), "") for w in _street_names(surface)]
    return [("word", w, f"g{given[w]}" if w in given else "") for w in map(str.lower, _LETTERS.findall(surface)) if len(w) > 1]


def _stream(key: bytes, text: str) -> Iterator[int]:
    n = 0
    while True:
        yield from hmac.digest(key, f"{n}|{text}".encode("utf-8", "surrogatepass"), "sha256")
        n += 1


def _base(c: str) -> str:
    return unicodedata.normalize("NFKD", c)[0].lower().replace("ł", "l").replace("ø", "o")


@lru_cache(maxsize=16)
def _letters(key: bytes) -> dict[str, str]:
    """The keyed image of every letter, of the same script and kind."""
    out = {}
    for script, alphabet in _ALPHABET.items():
        vowels = "".join(c for c in alphabet if c in ("aeiouy" if script == "latin" else "αεηιουω"))
        for part in (vowels, "".join(c for c in alphabet if c not in vowels)):
            rank = {c: hmac.digest(key, f"letter|{c}".encode(), "sha256") for c in part}
            out |= dict(zip(part, sorted(part, key=rank.__getitem__), strict=True))
    return out


def _made(r: Iterator[int], script: str, first: str, syllables: int) -> str:
    """An invented word that begins with ``first``, or with any letter if that is empty."""
    consonants, vowels = _CONSONANTS[script], _VOWELS[script]
    out = first
    if first and first not in vowels:
        out += vowels[next(r) % len(vowels)]
    for _ in range(syllables):
        out += consonants[next(r) % len(consonants)] + vowels[next(r) % len(vowels)]
    return out


def draw(kind: str, unit: str, hint: str, key: bytes, round_: int = 0) -> str:
    """The surrogate of a unit in its normal form; depends on the key, the unit and the round only."""
    r = _stream(key, f"{kind}|{round_}|{unit}")
    more = round_ // 2
    if kind == "phone":
        head = unit[: 1 + (1 if unit[1:2] in _ONE_DIGIT else 2 if unit[1:3] in _TWO_DIGITS else 3)] if unit[0] == "+" else unit[: len(unit) - len(unit.lstrip("0"))]
        return head + "".join(str(1 + next(r) % 9) if i == 0 else str(next(r) % 10) for i in range(len(unit) - len(head)))
    if kind == "id_number":
        return "".join(str(next(r) % 10) if c.isdigit() else chr(97 + next(r) % 26) for c in unit)
    script = "greek" if _GREEK.search(unit) else "latin"
    if kind in ("local", "domain"):
        labels = unit.split(".")
        kept = len(labels) - 1 if kind == "domain" else len(labels)
        made = lambda m: "".join(str(next(r) % 10) for _ in m[0]) if m[0].isdigit() else _made(r, "latin", "", max(2, (len(m[0]) + 1) // 2) + more)
        return ".".join(w if i >= kept or kind == "domain" and i and w in _REGISTRY_LABELS else re.sub(r"\d+|[^\W\d_]+", made, w) for i, w in enumerate(labels))
    if kind == "street":
        end = next((e for e in STREET_ENDINGS if unit.endswith(e) and len(unit) > len(e)), "")
        return _made(r, script, "", 3 + more) + end
    word = _made(r, script, _letters(key).get(_base(unit[0]), ""), 2 + more)
    end = _GENDERED.get((hint[1:2], script), "") if hint[:1] == "g" else ""
    return word[:-1] + end if end else word + _CONSONANTS[script][next(r) % len(_CONSONANTS[script])] * (hint[:1] != "g" and script == "latin")


def _cased(old: str, new: str) -> str:
    return new.upper() if old.isupper() and len(old) > 1 else new[:1].upper() + new[1:] if old[:1].isupper() else new


def _rejoin(old: str, new: str) -> str:
    """``new``, labels set off by points, in the spelling of ``old``: its points, blanks and capitals."""
    parts, labels = _DOT.split(old), new.split(".")
    if len(labels) * 2 - 1 != len(parts):
        return new
    for i, label in enumerate(labels):
        was = parts[2 * i]
        core = was.strip(" \xa0")
        parts[2 * i] = was.replace(core, label.upper() if core.isupper() and core != core.lower() else label, 1) if core else was
    return "".join(parts)


def written(kind: str, surface: str, drawn: dict[tuple[str, str], str], key: bytes) -> str:
    """The surrogate of an item in the spelling of its surface, from the surrogates of its units."""
    if kind == "email":
        sign = _SIGN.search(surface)
        local, _, domain = entity_key(kind, surface).rpartition("@")
        return _rejoin(surface[: sign.start()], drawn["local", local]) + sign[0] + _rejoin(surface[sign.end() :], drawn["domain", domain])
    if kind == "phone":
        unit, at = _phone(surface)
        out = list(surface)
        for i, c in zip(at, drawn["phone", unit].lstrip("+"), strict=True):
            out[i] = c
        return "".join(out)
    if kind == "id_number":
        new = iter(drawn["id_number", entity_key(kind, surface)])
        return "".join((n.upper() if c.isupper() else n) if c.isalnum() and (n := next(new)) else c for c in surface)
    if kind == "address":
        names = {w.lower() for w in _street_names(surface)}
        text = _LETTERS.sub(lambda m: _cased(m[0], drawn["street", m[0].lower()]) if m[0].lower() in names else m[0], surface)
        streets = " ".join(sorted(names))
        return re.sub(r"\d+", lambda m: _moved(m[0], streets, key), text)
    return _LETTERS.sub(lambda m: _cased(m[0], drawn["word", m[0].lower()]) if len(m[0]) > 1 else _letters(key).get(_base(m[0]), _base(m[0])).upper(), surface)


def _moved(digits: str, street: str, key: bytes) -> str:
    """A house number of as many digits; different numbers of one street stay different."""
    low = 10 ** (len(digits) - 1) if digits[0] != "0" else 0
    span = 10 ** len(digits) - low
    shift = int.from_bytes(hmac.digest(key, f"house|{street}|{len(digits)}".encode("utf-8", "surrogatepass"), "sha256")[:16], "big")
    return str(low + (int(digits) - low + 1 + shift % (span - 1)) % span).zfill(len(digits))


_UNITS = "kind string, surface string, n bigint, entity string, unit_kind string, unit string, hint string"
#: A key is hot above this share of all rows; so fewer than its inverse can be hot.
HOT_SHARE = 1 / 1000


def _by_weight(big: DataFrame, small: DataFrame, on: list[str], total: int) -> DataFrame:
    """``big`` joined to the distinct keys of ``small``, whose column ``n`` is the number of their rows in ``big``: hot keys,
    fewer than a thousand, are broadcast and their rows never shuffled; for the others no key is hot."""
    hot = F.col("n") > F.lit(max(1.0, total * HOT_SHARE))
    return big.join(F.broadcast(small.filter(hot)), on).unionByName(big.join(small.filter(~hot), on)).drop("n")


def _drawn_units(own: DataFrame, secret: bytes) -> DataFrame:
    """``unit_kind``, ``unit``, ``n``, ``drawn`` of distinct units: no two alike within a kind, and none that is itself a unit."""

    def draws(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["drawn"] = [draw(k, u, h, secret, int(n)) for k, u, h, n in zip(batch["unit_kind"], batch["unit"], batch["hint"], batch["round"], strict=True)]
            yield batch

    shape = "unit_kind string, unit string, hint string, n bigint, round int, drawn string"
    now = own.withColumn("round", F.lit(0))
    for _ in range(MAX_ROUNDS):
        drawn = cut(now.mapInPandas(draws, shape))
        real = drawn.select("unit_kind", F.col("unit").alias("drawn"), F.lit(None).cast("string").alias("unit"))
        both = drawn.select("unit_kind", "drawn", "unit").unionByName(real)
        # a surrogate that is a real unit has no rightful owner; else the first unit keeps it
        clash = both.groupBy("unit_kind", "drawn").agg(F.min("unit").alias("first"), F.count("unit").alias("n"), F.count_if(F.col("unit").isNull()).alias("n_real"))
        bad = clash.filter("n > 0 and n + n_real > 1").select("unit_kind", "drawn", F.when(F.col("n_real") == 0, F.col("first")).alias("first"), F.lit(True).alias("taken"))
        if bad.isEmpty():
            return drawn.select("unit_kind", "unit", "n", "drawn")
        again = F.coalesce(F.col("taken"), F.lit(False)) & ~F.col("first").eqNullSafe(F.col("unit"))
        now = drawn.join(bad, ["unit_kind", "drawn"], "left").select("unit_kind", "unit", "hint", "n", F.when(again, F.col("round") + 1).otherwise(F.col("round")).alias("round"))
    raise RuntimeError(f"surrogates still equal after {MAX_ROUNDS} rounds")


def _replacements(texts: DataFrame, shared: object, key: str) -> DataFrame:
    secret = key.encode()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = Names(*shared.value)
        for batch in batches:
            rows = []
            for d, h, t, r in zip(batch["doc_id"], batch["hash"], batch["text"], batch["rare"], strict=True):
                here = _names_of(names, r)
                for f in find(t, here):
                    s = t[f.start : f.end]
                    given = sorted(f"{w}:{here.gender(w)}" for w in set(_LETTERS.findall(s.lower())) if here.is_given(w)) if f.kind == "name" else []
                    rows.append((d, h, f.start, f.end, f.kind, s, " ".join(given)))
            out = pd.DataFrame(rows, columns=["doc_id", "hash", "start", "end", "kind", "surface", "given"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    found = cut(texts.withColumn("hash", F.xxhash64("text")).mapInPandas(run, "doc_id bigint, hash bigint, start int, end int, kind string, surface string, given string"))
    surfaces = found.groupBy("kind", "surface").agg(F.max("given").alias("given"), F.count(F.lit(1)).alias("n"))

    def apart(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for k, s, g, n in zip(batch["kind"], batch["surface"], batch["given"], batch["n"], strict=True):
                given = dict(x.split(":") for x in g.split())
                rows += [(k, s, n, entity_key(k, s), *u) for u in units(k, s, given) or [("", "", "")]]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in _UNITS.split(", ")])

    parts = cut(surfaces.mapInPandas(apart, _UNITS))
    named = parts.filter("unit_kind <> ''")
    drawn = _drawn_units(named.groupBy("unit_kind", "unit").agg(F.max("hint").alias("hint"), F.count(F.lit(1)).alias("n")), secret)
    filled = _by_weight(named.withColumnRenamed("n", "seen"), drawn, ["unit_kind", "unit"], named.count())
    every = filled.unionByName(parts.filter("unit_kind = ''").withColumnRenamed("n", "seen").withColumn("drawn", F.lit(None).cast("string")))
    by_surface = every.groupBy("kind", "surface", "entity").agg(F.max("seen").alias("n"), F.collect_list(F.struct("unit_kind", "unit", "drawn")).alias("units"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            new = [written(k, s, {(u["unit_kind"], u["unit"]): u["drawn"] for u in us}, secret) for k, s, us in zip(batch["kind"], batch["surface"], batch["units"], strict=True)]
            yield pd.DataFrame({"kind": batch["kind"], "surface": batch["surface"], "n": batch["n"], "entity": batch["entity"], "surrogate": new, "new_entity": [entity_key(k, n) for k, n in zip(batch["kind"], new, strict=True)]})

    table = cut(by_surface.mapInPandas(write, "kind string, surface string, n bigint, entity string, surrogate string, new_entity string"))
    real = table.select("kind", F.col("entity").alias("new_entity"), F.lit(None).cast("string").alias("entity"))
    seen = table.select("kind", "new_entity", "entity").distinct().unionByName(real.distinct())
    wrong = seen.groupBy("kind", "new_entity").agg(F.count("entity").alias("n"), F.count_if(F.col("entity").isNull()).alias("n_real")).filter("n > 1 or n > 0 and n_real > 0")
    if not wrong.isEmpty():
        raise RuntimeError(f"two entities with one surrogate, or one that is real: {wrong.first()}")
    return _by_weight(found.drop("given"), table.select("kind", "surface", "n", "entity", "surrogate"), ["kind", "surface"], found.count())


def replacements(df: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """``doc_id``, ``start``, ``end``, ``kind``, ``surface``, ``entity``, ``surrogate`` of every item of personal data.

    Distinct units whose surrogates are equal, or equal to a real unit, are told apart by rounds: of each group of equal
    surrogates the first unit keeps its own and the others draw again, until no two are equal; more than ``MAX_ROUNDS`` is
    an error, and so are two entities whose spellings as written are one. An item that has no unit (an initial alone) is
    written with the images of its letters.
    """
    return _replacements(*_with_names(df, id_col, text_col), key).drop("hash")


def surrogates(df: DataFrame, id_col: str, text_col: str, key: str) -> DataFrame:
    """``doc_id``, ``text`` of every row, each item replaced by its surrogate, as ``replacements`` gives it."""
    texts, shared = _with_names(df, id_col, text_col)
    found = _replacements(texts, shared, key)
    parts = found.groupBy(F.col("doc_id").alias("d"), F.col("hash").alias("h")).agg(F.collect_set(F.struct("start", "end", "surrogate")).alias("parts"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [t if ps is None else replaced(t, [(p["start"], p["end"], p["surrogate"]) for p in ps]) for t, ps in zip(batch["text"], batch["parts"], strict=True)]
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text": out})

    rows = texts.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("hash") == F.col("h"))
    return rows.join(parts, same, "left").select("doc_id", "text", "parts").mapInPandas(write, "doc_id bigint, text string")
