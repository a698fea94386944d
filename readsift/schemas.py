"""Explicit schemas; nothing in the library infers a type."""

from pyspark.sql import types as T


def _strings(*names):
    return [T.StructField(n, T.StringType(), True) for n in names]


READ = T.StructType(
    _strings("read_id", "description", "seq", "qual")
    + [T.StructField("rec_no", T.LongType(), True)]
    + _strings("source_file")
)

SEQUENCE = T.StructType(_strings("read_id", "description", "seq"))

HIT_FIELDS = ["qaccver", "saccver", "sskingdom", "ssciname", "salltitles", "pident", "evalue"]

HIT = T.StructType(
    _strings(*HIT_FIELDS[:5])
    + [T.StructField("pident", T.DoubleType(), True), T.StructField("evalue", T.DoubleType(), True)]
)

TAXMAP = T.StructType(_strings("accession") + [T.StructField("taxid", T.LongType(), True)])

SCORE = T.StructType(_strings("id") + [T.StructField("score", T.DoubleType(), True)])

# The words a hit table may hold in place of a missing value.
NULL_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
