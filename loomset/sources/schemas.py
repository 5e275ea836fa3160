"""Explicit schemas. Readers never infer."""

from pyspark.sql import types as T

DOCUMENT_SAMPLE = T.StructType([
    T.StructField("source_path", T.StringType()),
    T.StructField("doc_id", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("char_len", T.IntegerType()),
    T.StructField("tok_len", T.IntegerType()),
    T.StructField("chunks", T.ArrayType(T.StringType())),
    T.StructField("needs_chunking", T.BooleanType()),
    T.StructField("template_hint", T.StringType()),
])

PACKED_SAMPLE = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("generator_version", T.StringType()),
    T.StructField("raw_input", T.StructType([
        T.StructField("text", T.StringType()),
        T.StructField("token_count", T.IntegerType()),
        T.StructField("style", T.StringType()),
    ])),
    T.StructField("classification", T.StructType([
        T.StructField("document_type", T.StringType()),
        T.StructField("complexity", T.StringType()),
        T.StructField("complexity_level", T.StringType()),
        T.StructField("industry", T.StringType()),
    ])),
    T.StructField("extracted_fields", T.MapType(T.StringType(), T.StringType())),
    T.StructField("validation", T.StructType([
        T.StructField("semantic_coherence", T.DoubleType()),
        T.StructField("business_ok", T.BooleanType()),
        T.StructField("temporal_ok", T.BooleanType()),
        T.StructField("dedup_hash", T.StringType()),
    ])),
    T.StructField("template_hint", T.StringType()),
    T.StructField("is_ood", T.BooleanType()),
])

CHUNK = T.StructType([
    T.StructField("sample_id", T.StringType()),
    T.StructField("chunk_id", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("token_count", T.IntegerType()),
    T.StructField("labels", T.ArrayType(T.StringType())),
])
