"""Explicit schemas of the library's tables."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

#: The fields of the common site record, in order.
RECORD_COLUMNS = [
    "hostname", "tipo_link", "nome_ente", "comune", "regione", "codice_ipa", "sector", "country_code",
    "source_name", "retrieved_at", "dominio_radice", "host_osservati", "found_on", "source_seed", "tls_error",
]
SITE_RECORD = StructType([StructField(c, StringType()) for c in RECORD_COLUMNS])
