import zlib

import numpy as np
import pytest

from paperflow.llm import id_store
from paperflow.llm.tokens import Encoder, vocabulary_path
from paperflow.session import scratch_path

from .helpers import docs, sf_docs


def expected(rows):
    whole, start, out = Encoder(vocabulary_path()).whole, 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole.encode(text or "", add_special_tokens=False).ids + [id_store.END_ID]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_round_trip(spark):
    frame = sf_docs(spark)
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    path = scratch_path(spark, "store")
    id_store.write_store(frame, path, block_bytes=20_000)
    assert sorted(map(tuple, id_store.read_store(spark, path).collect())) == expected(rows)
    blocks = spark.read.parquet(f"{path}/blocks").collect()
    assert len(blocks) > 5
    some = rows[17]
    ids = id_store.read_document(spark, path, some[0])
    assert ids.tolist() == Encoder(vocabulary_path()).whole.encode(some[1], add_special_tokens=False).ids + [2]
    assert id_store.read_document(spark, path, -5) is None
    with pytest.raises(ValueError, match="dictionary"):
        id_store.Block(bytes(blocks[0]["block"]), b"another")
    dictionary = id_store.read_dictionary(spark, path)
    assert dictionary and id_store.dictionary_hash(dictionary) == bytes(blocks[0]["block"])[5:37]


def test_edges(spark):
    rows = [(5, None), (2, ""), (None, "b"), (7, "word " * 5000), (7, "word " * 5000), (-3, "a b c")]
    out = id_store.store_and_read(docs(spark, rows)).collect()
    assert sorted(map(tuple, out), key=lambda r: r[1]) == expected(rows)
    assert id_store.store_and_read(docs(spark, [])).count() == 0


def test_width_must_hold_the_vocabulary(spark):
    with pytest.raises(ValueError, match="bytes"):
        id_store.write_store(docs(spark, []), scratch_path(spark, "store"), width=1)
