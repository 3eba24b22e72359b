"""Sources: folders of a corpus, one per paper, and files by content."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_SLUG = r"/([^/]+)/[^/]+$"


def read_records(spark: SparkSession, root: str, name: str, schema: StructType | str) -> DataFrame:
    """One row per root/<slug>/name, a JSON object each, with slug; unreadable records are left out. Folders whose names
    begin with an underscore are no papers."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    bad = StructType([*schema.fields]).add("_corrupt", "string")
    r = spark.read.schema(bad).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(f"{root}/*/{name}")
    r = r.withColumn("slug", F.regexp_extract(F.input_file_name(), _SLUG, 1))
    return r.where(F.col("_corrupt").isNull() & ~F.col("slug").startswith("_")).select("slug", *schema.names)


def read_texts(spark: SparkSession, root: str, name: str = "raw_text.txt") -> DataFrame:
    """(slug, text): whole text files of a corpus's folders."""
    t = spark.read.text(f"{root}/*/{name}", wholetext=True).withColumn("slug", F.regexp_extract(F.input_file_name(), _SLUG, 1))
    return t.where(~F.col("slug").startswith("_")).select("slug", F.col("value").alias("text"))


def read_files(spark: SparkSession, root: str, pattern: str = "*.pdf") -> DataFrame:
    """(sha, path, length): the first path of each content under root. Contents are hashed where they are read; only the
    hashes are shuffled."""
    f = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root)
    f = f.select(F.substring(F.sha2("content", 256), 1, 16).alias("sha"), "path", "length")
    return f.groupBy("sha").agg(F.min(F.struct("path", "length")).alias("x")).select("sha", "x.path", "x.length")
