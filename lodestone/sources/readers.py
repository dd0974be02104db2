"""Scans with explicit schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone import schemas
from lodestone.constants import CONDITIONS, DEFAULT_THRESHOLD
from lodestone.operators.dedup import keep_first
from lodestone.sources.contents import known_scheme, list_files, with_content


def path_exists(spark: SparkSession, path: str) -> bool:
    """Asks the file system the path belongs to."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def first_existing(spark: SparkSession, candidates: Sequence[str]) -> str:
    for path in candidates:
        if path_exists(spark, path):
            return path
    raise FileNotFoundError(f"none of these exists: {', '.join(candidates)}")


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deals the rows of a scan out to all cores when its files make too few splits.

    A scan that already has a split per core is returned as it is, so a large
    table is never shuffled for this.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted)


def read_corpus(spark: SparkSession, path: str, lines: bool = False, schema: T.StructType = schemas.DOCUMENT) -> DataFrame:
    """Documents from JSON arrays, or from JSON lines, which split at scale.

    Missing keys become empty strings, except the year, which stays null.
    """
    raw = spark.read.schema(schema).option("multiLine", not lines).json(path)
    texts = {c: F.coalesce(c, F.lit("")) for c in ("id", "title", "abstract", "full_text")}
    no_words = F.array().cast("array<string>")
    return raw.withColumns({**texts, "year": F.nullif("year", F.lit("")), "keywords": F.coalesce("keywords", no_words)})


def load_corpus(spark: SparkSession, path: str, fallback: DataFrame, lines: bool = False) -> DataFrame:
    """The corpus at ``path``, or the fallback documents when there is none."""
    return read_corpus(spark, path, lines) if path_exists(spark, path) else fallback


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """Landed nested records, one JSON object per line; unreadable lines keep their text."""
    return (
        spark.read.schema(schemas.RAW_RECORD)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def read_raw_xml(spark: SparkSession, path: str, row_tag: str = "PubmedArticle") -> DataFrame:
    """The same records as XML; the parts of an abstract come as a list and are written back as JSON text."""
    article = T.StructType(
        [
            T.StructField("ArticleTitle", T.StringType()),
            T.StructField("Abstract", T.StructType([T.StructField("AbstractText", T.ArrayType(T.StringType()))])),
            T.StructField(
                "Journal",
                T.StructType(
                    [T.StructField("JournalIssue", T.StructType(
                        [T.StructField("PubDate", T.StructType([T.StructField("Year", T.StringType())]))]
                    ))]
                ),
            ),
        ]
    )
    words = T.StructType([T.StructField("Keyword", T.ArrayType(T.StringType()))])
    citation = T.StructType(
        [
            T.StructField("PMID", T.StringType()),
            T.StructField("Article", article),
            T.StructField("KeywordList", T.ArrayType(words)),
        ]
    )
    raw = (
        spark.read.format("xml").option("rowTag", row_tag)
        .schema(T.StructType([T.StructField("MedlineCitation", citation)])).load(path)
    )
    c = F.col("MedlineCitation")
    a = c["Article"]
    return raw.select(
        F.struct(
            c["PMID"].alias("PMID"),
            F.struct(
                a["ArticleTitle"].alias("ArticleTitle"),
                F.struct(F.to_json(a["Abstract"]["AbstractText"]).alias("AbstractText")).alias("Abstract"),
                a["Journal"].alias("Journal"),
            ).alias("Article"),
            c["KeywordList"]["Keyword"].alias("KeywordList"),
        ).alias("MedlineCitation")
    )


# File names the image label table is published under.
LABEL_FILES = ["Data_Entry_2017.csv", "Data_Entry_2017_v2020.csv"]


def read_image_labels(spark: SparkSession, data_dir: str, names: Sequence[str] = LABEL_FILES) -> DataFrame:
    """(image, findings, patient_id) from the first label file present.

    Some files carry more columns, so they are picked by header name.
    """
    path = first_existing(spark, [f"{data_dir}/{name}" for name in names])
    raw = spark.read.option("header", True).csv(path)
    patient = F.col("`Patient ID`") if "Patient ID" in raw.columns else F.lit(None)
    return raw.select(
        F.col("`Image Index`").alias("image"),
        F.col("`Finding Labels`").alias("findings"),
        patient.cast("string").alias("patient_id"),
    )


def list_images(spark: SparkSession, image_dir: str) -> DataFrame:
    """(image, path, length): one file per name, by the fixed order of the folders it may lie in; without their bytes.

    The order is the top folder, then images_NNN/images/, then images_NNN/, for NNN 001 to 012.
    """
    inner = F.regexp_extract("path", r"/images_(\d{3})/images/[^/]+$", 1).try_cast("int")
    outer = F.regexp_extract("path", r"/images_(\d{3})/[^/]+$", 1).try_cast("int")
    place = (
        F.when(inner.between(1, 12), inner)
        .when(outer.between(1, 12), outer + 12)
        .when(~F.col("path").rlike(r"/images_\d{3}/"), F.lit(0))
    )
    named = list_files(spark, image_dir).select(F.element_at(F.split("path", "/"), -1).alias("image"), place.alias("place"), "path", "length")
    return keep_first(named.filter("place IS NOT NULL"), "image", ["place", "path"]).select("image", "path", "length")


def _contents(spark: SparkSession, listed: DataFrame, folder: str) -> DataFrame:
    """The listed files with ``content``; where tasks can't open files, by a join with Spark's own scan."""
    if known_scheme(spark, folder):
        return with_content(listed)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    return listed.join(files.select("path", "content"), "path").select(*listed.columns, "content")


def read_images(spark: SparkSession, image_dir: str) -> DataFrame:
    """(image, path, content) of ``list_images``."""
    return _contents(spark, list_images(spark, image_dir), image_dir).select("image", "path", "content")


def with_images(labels: DataFrame, images: DataFrame) -> DataFrame:
    """Every label row, with ``is_missing`` where no file was found.

    Give it ``list_images`` and put ``with_content`` behind it: then no bytes are joined, and only those of labelled files read.
    """
    return labels.join(images, "image", "left").withColumn("is_missing", F.col("path").isNull())


def list_class_folders(spark: SparkSession, root: str) -> DataFrame:
    """(path, split, class_name, class_index, length) from root/<train|val|test>/<class>/file.

    Class numbers follow the alphabetical order of the class names.
    """
    from pyspark.sql import Window as W

    where = r"/(train|val|test)/([^/]+)/[^/]+$"
    placed = list_files(spark, root).select(
        "path", F.regexp_extract("path", where, 1).alias("split"), F.regexp_extract("path", where, 2).alias("class_name"), "length",
    ).filter("split <> ''")
    names = placed.select("class_name").distinct()  # a handful
    numbered = names.withColumn("class_index", F.row_number().over(W.orderBy("class_name")) - 1)
    return placed.join(numbered, "class_name")


def read_class_folders(spark: SparkSession, root: str) -> DataFrame:
    """``list_class_folders`` with ``content``."""
    return _contents(spark, list_class_folders(spark, root), root).drop("length")


def read_thresholds(spark: SparkSession, path: str, conditions: Sequence[str] = CONDITIONS,
                    default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """(condition, threshold) for each condition: its own name, else with underscores, else the default."""
    wanted = F.array(*[F.lit(c) for c in conditions])
    if not path_exists(spark, path):
        return spark.range(1).select(F.explode(wanted).alias("condition"), F.lit(default).alias("threshold"))
    file = spark.read.schema(schemas.THRESHOLD_FILE).option("multiLine", True).json(path)
    each = file.select("thresholds", F.explode(wanted).alias("condition"))
    own = F.try_element_at("thresholds", F.col("condition"))
    spelled = F.try_element_at("thresholds", F.replace("condition", F.lit(" "), F.lit("_")))
    return each.select("condition", F.coalesce(own, spelled, F.lit(default)).alias("threshold"))


def read_keyword_cases(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.KEYWORD_CASE).option("multiLine", True).json(path).withColumnRenamed("id", "query_id")


def read_topics(spark: SparkSession, path: str) -> DataFrame:
    """(query_id, query, difficulty, topic_pos, topic)."""
    cases = spark.read.schema(schemas.SEMANTIC_CASE).option("multiLine", True).json(path)
    return cases.select(
        F.col("id").alias("query_id"), "query", "difficulty", F.posexplode("expected_topics").alias("topic_pos", "topic")
    )


def load_index(spark: SparkSession, path: str, model: str | None = None, strategy: str | None = None) -> DataFrame:
    """A saved index; model and strategy are partition columns, so only their files are read."""
    index = spark.read.parquet(path)
    if model is not None:
        index = index.filter(F.col("embedding_model") == model)
    if strategy is not None:
        index = index.filter(F.col("chunking_strategy") == strategy)
    return index
