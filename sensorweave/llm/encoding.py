"""SentencePiece encoding and decoding of whole columns by streaming Viterbi."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorweave.llm.pieces import Encoder, PieceModel, decode
from sensorweave.llm.words import kept_in_worker, slices


def _unused(docs: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in docs.columns):
        raise ValueError(f"there is a column {name} already: choose another name for the result")


def encode_column(docs: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with the ids of a text as a further array column. Null stays null, empty gives an empty array.

    A column of the name ``out`` that is there already is an error; other columns stay as they are.
    """
    _unused(docs, out)

    def run(batches):
        import pyarrow as pa

        encoder = kept_in_worker(f"encoder {path}", lambda: Encoder(PieceModel(path)))
        for batch in slices(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            coded = encoder.of([t or "" for t in texts])
            ids = [None if t is None else np.frombuffer(c, "<u4").astype(np.int32) for t, c in zip(texts, coded)]
            yield batch.append_column(out, pa.array(ids, pa.list_(pa.int32())))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))]))


def decode_column(docs: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``docs`` with the text of an id array as a further column. Null stays null, an empty array gives an empty text.

    A column of the name ``out`` that is there already is an error; other columns stay as they are.
    """
    _unused(docs, out)

    def run(batches):
        import pyarrow as pa

        model = PieceModel(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col)).to_pylist()
            yield batch.append_column(out, pa.array([None if x is None else decode(model, x) for x in ids], pa.string()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.StringType())]))


def digest(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``n_tokens``, ``ids_crc32`` of the ids as 32-bit little-endian numbers, ``round_trip``.

    The last says whether decoding the ids gives the text again. Null counts as empty.
    """

    def run(batches):
        import pyarrow as pa

        encoder = kept_in_worker(f"encoder {path}", lambda: Encoder(PieceModel(path)))
        model = encoder.model
        for batch in slices(batches):
            texts = [t or "" for t in batch["_text"].to_pylist()]
            coded = encoder.of(texts)
            same = [decode(model, np.frombuffer(c, "<u4").tolist()) == t for c, t in zip(coded, texts)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch[id_col],
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array([zlib.crc32(c) for c in coded], pa.int64()),
                    pa.array(same, pa.bool_()),
                ],
                [id_col, "n_tokens", "ids_crc32", "round_trip"],
            )

    schema = T.StructType(
        [
            docs.schema[id_col],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
            T.StructField("round_trip", T.BooleanType()),
        ]
    )
    return docs.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)
