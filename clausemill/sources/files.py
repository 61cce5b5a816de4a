"""Files in and out: unit CSVs, clause sheets, the coverage map, summaries, and the partitioned unit table."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

COVERAGE_SCHEMA = """volumes array<struct<volume: string, topics: array<struct<topic_id: string, section_code: string,
  min_keyword_matches: int, keywords: array<string>, exclude_keywords: array<string>,
  routes: array<struct<part_codes: array<string>, disciplines: array<string>>>, allowed_unit_types: array<string>,
  required_aspects: array<string>, aspect_extractors: array<struct<aspect: string, patterns: array<string>>>,
  guardrails: struct<disallow_volumes: array<string>, must_match: array<string>, disallow_if_only_unit_type: array<string>,
    if_missing_must_say: array<string>, if_question_mentions: array<string>, must_use_phrases: array<string>,
    must_state: array<string>, must_explain: array<string>, must_not_cite_sections: array<string>, custom_rules: array<struct<rule: string, if_question_contains: array<string>,
    must_include_phrase: array<string>, disallow_phrases: array<string>>>>>>>>"""


def scratch_path(spark: SparkSession) -> str:
    """A new folder below the cluster's shared ``spark.checkpoint.dir``; a temporary one in a session of one machine only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{(base or tempfile.mkdtemp(prefix='spark-')).rstrip('/')}/files-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the scratch folder and read back, for a table that several branches of a plan read: it is made once,
    its lineage ends here, and its size is known."""
    path = scratch_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _csv(spark: SparkSession, path: str, schema: T.StructType | str, mode: str) -> DataFrame:
    # Without pruning every row is parsed whole, so that short rows are known as such.
    return spark.read.option("columnPruning", "false").csv(path, schema=schema, header=True, enforceSchema=False, quote='"', escape='"', mode=mode, multiLine=False)


def read_units_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S-4: quoted CSV with doubled quotes and a header; rows with another number of fields are dropped."""
    return _csv(spark, path, schema, "DROPMALFORMED").na.fill("")


def read_units_csv_padded(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S-5: short rows are filled up with ''."""
    return _csv(spark, path, schema, "PERMISSIVE").na.fill("")


def read_qa_csv(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_qa_csv`` wrote, breaks included; empty fields are ''."""
    return spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).na.fill("")


def read_clause_sheet(spark: SparkSession, path: str) -> DataFrame:
    """S-6: a sheet with the six clause columns, missing values ''. A sheet without rows is an error."""
    out = spark.read.csv(path, header=True, quote='"', escape='"', multiLine=True).na.fill("")
    names = {c: c.strip().lower().replace(" ", "_") for c in out.columns}
    out = out.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    if out.isEmpty():
        raise ValueError("the clause sheet has no rows")
    for c in ("clause_number", "clause_text", "notes", "exceptions", "warnings", "jurisdiction"):
        if c not in out.columns:
            out = out.withColumn(c, F.lit(""))
    return out


#: The lists of phrases of a topic's guardrails.
ANSWER_KINDS = ["must_use_phrases", "must_state", "must_explain", "must_not_cite_sections"]


def read_coverage_map(spark: SparkSession, path: str, lines: bool = False) -> dict[str, DataFrame]:
    """S-7: topic, topic_part, topic_keyword, topic_unit_type, aspect, guardrail, phrase_rule and answer_rule of a coverage map in
    JSON: one object, or with ``lines`` one on each line, which Spark reads in pieces. A file that is missing, empty or
    without volumes gives empty tables; a list that a topic lacks is an empty one."""
    try:
        raw = spark.read.schema(COVERAGE_SCHEMA).json(path, multiLine=not lines)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], COVERAGE_SCHEMA)
    topics = raw.select(F.explode("volumes").alias("v")).select("v.volume", F.explode("v.topics").alias("t"))
    parts = topics.select("t.topic_id", F.posexplode("t.routes").alias("r", "route")).select("topic_id", "r", F.posexplode("route.part_codes").alias("p", "part_code"), "route.disciplines")
    words = lambda c, kind: topics.select("t.topic_id", F.explode(f"t.{c}").alias("keyword"), F.lit(kind).alias("kind"))
    none = F.array().cast("array<string>")
    rules = topics.select("t.topic_id", "t.guardrails.*")
    pattern = topics.select("t.topic_id", F.coalesce("t.required_aspects", none).alias("needed"), F.coalesce("t.guardrails.must_match", none).alias("must"), F.explode("t.aspect_extractors").alias("a"))
    return {
        "topic_unit_type": topics.select("t.topic_id", F.explode("t.allowed_unit_types").alias("unit_type")),
        "aspect": pattern.select("topic_id", "a.aspect", F.explode("a.patterns").alias("pattern"), F.array_contains("needed", F.col("a.aspect")).alias("required"), F.array_contains("must", F.col("a.aspect")).alias("must_match")),
        "guardrail": rules.select("topic_id", F.coalesce("disallow_volumes", none).alias("disallow_volumes"), F.coalesce("disallow_if_only_unit_type", none).alias("disallow_if_only"), F.array_join(F.coalesce("if_missing_must_say", none), " ").alias("must_say")),
        "phrase_rule": rules.select("topic_id", F.explode("custom_rules").alias("r")).select("topic_id", "r.rule", F.coalesce("r.if_question_contains", none).alias("if_question_contains"), F.coalesce("r.must_include_phrase", none).alias("must_include"), F.coalesce("r.disallow_phrases", none).alias("disallow")),
        "answer_rule": reduce(DataFrame.unionByName, [rules.select("topic_id", F.explode(k).alias("phrase"), F.lit(k).alias("kind"), F.coalesce("if_question_mentions", none).alias("if_mentions")) for k in ANSWER_KINDS]),
        "topic": topics.select("t.topic_id", "volume", "t.section_code", F.coalesce("t.min_keyword_matches", F.lit(1)).alias("min_keyword_matches")),
        "topic_part": parts.select("topic_id", (F.col("r") * 1000 + F.col("p")).alias("seq"), "part_code", F.explode("disciplines").alias("discipline")),
        "topic_keyword": words("keywords", "include").unionByName(words("exclude_keywords", "exclude")),
    }


def _flat(df: DataFrame) -> DataFrame:
    """Line breaks in text columns to spaces."""
    return df.select(*[F.regexp_replace(c, r"\r\n|\r|\n", " ").alias(c) if t == "string" else F.col(c) for c, t in df.dtypes])


def write_units_csv(units: DataFrame, path: str) -> None:
    """S-8: header and rows; line breaks become spaces, empty fields are quoted, booleans lower case."""
    _flat(units).write.csv(path, header=True, quote='"', escape='"', emptyValue='""', nullValue='""', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_qa_csv(units: DataFrame, path: str) -> None:
    """S-10: header and rows; line breaks stay, only fields with a comma, quote or break are quoted, empty ones are bare."""
    units.write.csv(path, header=True, quote='"', escape='"', emptyValue="", nullValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_clauses_csv(clauses: DataFrame, path: str) -> None:
    """S-9: the clean clause columns in order; line breaks stay, empty fields are bare, booleans True and False."""
    from clausemill.operators.normalize import CLEAN_COLUMNS

    kinds = dict(clauses.dtypes)
    cols = [F.initcap(F.col(c).cast("string")).alias(c) if kinds[c] == "boolean" else F.col(c) for c in CLEAN_COLUMNS]
    clauses.select(*cols).write.csv(path, header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def write_summary(counts: DataFrame, path: str, source: str, target: str) -> None:
    """S-11: one row of counts as JSON with the paths and the time."""
    counts.select(F.lit(source).alias("input"), F.lit(target).alias("output"), "*", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp")).coalesce(1).write.json(path)


def write_unit_table(units: DataFrame, path: str) -> None:
    """S-13: one Parquet table, a folder per volume, so that reads of a volume skip the others."""
    units.write.partitionBy("volume").mode("append").parquet(path)


def read_unit_table(spark: SparkSession, path: str, volume: str | None = None) -> DataFrame:
    table = spark.read.parquet(path)
    return table if volume is None else table.where(F.col("volume") == volume)
