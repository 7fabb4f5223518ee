import hashlib

import public_tokenizers
import tiktoken

from urlsieve.llm import bpe, queries

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_edges_round_trip(spark):
    long = "Überlänge 12345 " * 20_000
    texts = ["", None, "a", "  two  spaces\n\n\tend ", "it's we'll 've", "naïve 東京 🙂🙂 \u0000x", long, "a", "<|endoftext|>"]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string, bytes string")
    out = {r.doc_id: r for r in bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS).collect()}
    for i, t in enumerate(texts):
        assert out[i].ids == reference().encode_ordinary(t or "")
        assert bytes(out[i]["bytes"]) == (t or "").encode()
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_every_token_is_reached():
    cache = bpe.PieceCache(bpe.model_bytes(RANKS))
    assert cache.token == [t for t, _ in sorted(RANKS.items(), key=lambda x: x[1])]
    assert not cache.unreached


def test_query_matches_reference_tokenizer(spark, sf_dir):
    got = {r.doc_id: r for r in queries.op3_byte_bpe(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(docs) == len(got)
    for d in docs:
        ids = reference().encode_ordinary(d.text or "")
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
