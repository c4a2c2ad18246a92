import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tessera.llm.packing import encoder, op2_packing, pack

from ..conftest import SMALL


def plain():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda s: [*t.encode(s or "", add_special_tokens=False).ids, 0]


def test_every_id_in_one_piece(spark):
    encode = plain()
    want = {r["doc_id"]: encode(r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    pieces = op2_packing(spark, SMALL).collect()
    at = {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        ids = want[p["doc_id"]]
        assert p["start"] == at.get(p["doc_id"], 0) and p["doc_tokens"] == len(ids)
        at[p["doc_id"]] = p["start"] + p["length"]
        assert zlib.crc32(np.array(ids[p["start"] : at[p["doc_id"]]], "<u4").tobytes()) == p["ids_crc32"]
    assert at == {k: len(v) for k, v in want.items()}
    full = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == full.get(p["sequence_id"], 0)
        full[p["sequence_id"]] = p["offset"] + p["length"]
    assert sorted(full) == list(range(len(full)))
    assert all(n == 1024 for k, n in full.items() if k < len(full) - 1) and full[len(full) - 1] <= 1024


def test_round_trip_of_odd_rows(spark, odd_docs, no_docs):
    encode = plain()
    pieces = sorted(pack(odd_docs, width=64).collect(), key=lambda p: (p["sequence_id"], p["offset"]))
    stream = np.concatenate([np.frombuffer(bytes(p["ids"]), "<u2") for p in pieces]).tolist()
    texts = [r["text"] for r in odd_docs.collect()]
    docs, doc = [], []
    for i in stream:
        doc.append(i)
        if i == 0:
            docs.append(tuple(doc))
            doc = []
    assert sorted(tuple(x for x in encode(t)) for t in texts if 0 not in encode(t)[:-1]) == sorted(docs)
    assert sum(p["doc_id"] is None for p in pieces) > 0
    assert pack(no_docs).count() == 0


def test_encoder_equals_the_public_tokenizer():
    encode, want = encoder(), plain()
    for s in ("", " ", "a  b\n\n c'll 12é🎉", "x<|endoftext|>y", "A" * 300):
        assert [*encode(s), 0] == want(s)


def test_clashing_names(spark):
    """Columns named like outputs, beside the id and the text, change nothing."""
    df = spark.createDataFrame([(1, "one two", 5, "x"), (2, None, None, None)], "doc_id long, text string, start long, sequence_id string")
    plain, clash = (sorted(map(tuple, pack(x).drop("ids").collect())) for x in (df.select("doc_id", "text"), df))
    assert plain == clash and [r[:2] for r in plain] == [(1, 0), (2, 0)]
