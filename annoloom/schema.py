"""Table shapes and the fixed label values of the annotation form."""

from __future__ import annotations

from pyspark.sql import types as T

TEXTS = T.StructType([
    T.StructField("benchmark", T.StringType()),
    T.StructField("config", T.StringType()),          # queries | corpus
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("seq", T.LongType()),               # order within the source
])

RELEVANCE = T.StructType([
    T.StructField("benchmark", T.StringType()),
    T.StructField("query_id", T.StringType()),
    T.StructField("corpus_id", T.StringType()),
    T.StructField("seq", T.LongType()),
])

RECORDS = T.StructType([
    T.StructField("record_id", T.StringType()),
    T.StructField("benchmark", T.StringType()),
    T.StructField("record_type", T.StringType()),     # query | passage
    T.StructField("task_id", T.StringType()),
    T.StructField("source_text", T.StringType()),
    T.StructField("target_text", T.StringType()),
    T.StructField("status", T.StringType()),          # pending | completed | discarded
])

RESPONSES = T.StructType([
    T.StructField("response_id", T.StringType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("status", T.StringType()),          # submitted | draft | discarded
    T.StructField("quality_score", T.StringType()),
    T.StructField("error_categories", T.ArrayType(T.StringType())),
    T.StructField("corrected_text", T.StringType()),
    T.StructField("comment", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])

USERS = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("username", T.StringType()),
    T.StructField("role", T.StringType()),            # owner | annotator
])

# ---- Fixed values: the annotation form's labels, benchmark names and markers ----

BENCHMARKS = (
    "NanoArguAna", "NanoTouche2020", "NanoSciFact", "NanoSCIDOCS", "NanoNQ",
    "NanoNFCorpus", "NanoMSMARCO", "NanoFiQA2018", "NanoHotpotQA", "NanoFEVER",
    "NanoDBPedia", "NanoQuoraRetrieval", "NanoClimateFEVER",
)

SCORE_LABELS = (
    "1 – Potpuno netačan",
    "2 – Veće greške",
    "3 – Adekvatan",
    "4 – Dobar",
    "5 – Odličan",
)

NO_ERROR_LABEL = "Nema grešaka"

ERROR_CATEGORIES = (
    "Pogrešno značenje",
    "Nedostaje informacija",
    "Dodat sadržaj",
    "Gramatičke greške",
    "Deklinacija / konjugacija",
    "Imenovani entiteti",
    "Pravopis",
    "Terminologija",
    "Neprirodan stil",
    "Nema grešaka",
)

# Corrections that mean "nothing was corrected", after strip and lower-case.
NO_CORRECTION_MARKERS = (
    "", "no corrections", "no correction", "no corrections needed", "no correction needed",
)
LEGACY_NO_CORRECTION_MARKERS = ("bez ispravki", "no corrections", "")
LEGACY_UNMODIFIED_TEXT = "Bez ispravki"

QUALITY_BANDS = ("high", "medium", "low")
DONE_STATUSES = ("completed", "discarded")
RECORD_TYPES = ("query", "passage")
PAIR_FILE_KEYS = ("id", "source_text_en", "translated_text_sr")

# ---- End of fixed values ----
