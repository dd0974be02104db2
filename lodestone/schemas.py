"""Explicit schemas; readers never infer."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _I, _L, _D, _B, _TS = (
    T.StringType(),
    T.IntegerType(),
    T.LongType(),
    T.DoubleType(),
    T.BooleanType(),
    T.TimestampType(),
)
_STRINGS = T.ArrayType(T.StringType())
_VECTOR = T.ArrayType(T.FloatType())

DOCUMENT = _struct(id=_S, title=_S, abstract=_S, full_text=_S, year=_S, keywords=_STRINGS)

CHUNK = _struct(doc_id=_S, chunk_index=_I, chunk_text=_S, char_count=_I, content_hash=_S)

EMBEDDED_CHUNK = T.StructType([*CHUNK.fields, T.StructField("embedding", _VECTOR, True)])

STORED_DOCUMENT = _struct(
    pmid=_S,
    title=_S,
    abstract=_S,
    publication_date=T.DateType(),
    keywords=_STRINGS,
    embedding_vector=_VECTOR,
    created_at=_TS,
    updated_at=_TS,
)

STORED_EMBEDDING = _struct(
    doc_id=_S,
    chunk_index=_I,
    chunk_text=_S,
    content_hash=_S,
    embedding_model=_S,
    chunking_strategy=_S,
    embedding=_VECTOR,
    created_at=_TS,
)

QUERY_LOG = _struct(
    query_text=_S,
    prediction=_S,
    confidence=_D,
    retrieved_doc_ids=_STRINGS,
    response_text=_S,
    latency_ms=_D,
    success=_B,
    error_message=_S,
    created_at=_TS,
)

MODEL_VERSION = _struct(
    model_type=_S, version=_S, accuracy=_D, metrics=_S, file_path=_S, is_active=_B, created_at=_TS
)

KEYWORD_CASE = _struct(
    id=_I,
    query=_S,
    cnn_prediction=_S,
    expected_topics=_STRINGS,
    expected_keywords=_STRINGS,
    difficulty=_S,
    clinical_context=_S,
)

SEMANTIC_CASE = _struct(id=_I, query=_S, expected_topics=_STRINGS, difficulty=_S)

IMAGE_LABEL_CSV = T.StructType(
    [
        T.StructField("Image Index", _S, True),
        T.StructField("Finding Labels", _S, True),
        T.StructField("Patient ID", _S, True),
    ]
)

THRESHOLD_FILE = _struct(
    thresholds=T.MapType(_S, _D), method=_S, mean_f1_default=_D, mean_f1_optimized=_D
)

# A landed publication record.  AbstractText is kept as raw JSON text because
# sources write it both as a list and as a single string.
RAW_RECORD = T.StructType(
    [
        T.StructField(
            "MedlineCitation",
            _struct(
                PMID=_S,
                Article=_struct(
                    ArticleTitle=_S,
                    Abstract=_struct(AbstractText=_S),
                    Journal=_struct(JournalIssue=_struct(PubDate=_struct(Year=_S))),
                ),
                KeywordList=T.ArrayType(_STRINGS),
            ),
            True,
        ),
        T.StructField("_corrupt_record", _S, True),
    ]
)

EVENT = _struct(event_id=_L, ts=T.TimestampNTZType(), user_id=_L, event_type=_S, value=_D, props=_S)
