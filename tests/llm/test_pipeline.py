import hashlib

import corpus_pipeline as cp
import tiktoken
from tallyforge.llm import bpe, catalog

from test_dartminhash import brute


def test_stages_take_effect(spark, odd, odd_rows, tmp_path):
    """Each stage against a brute-force version of what it is to leave, on what its predecessor kept."""
    encoding = tiktoken.Encoding("own", pat_str=bpe.pattern(), mergeable_ranks=bpe.load_ranks(bpe.vocabulary_path()), special_tokens={})
    docs = odd.drop("score", "digest", "n")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(cp.STAGES[:-1]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == columns, name
        out.write.parquet(str(tmp_path / f"out{k}"))
        docs = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen.append(sorted(r.text or "" for r in docs.collect()))
    assert all(any(c.isalpha() for c in t) for t in seen[0])
    assert seen[1] == sorted(set(seen[0]))
    assert len(seen[2]) < len(seen[1]) and set(seen[2]) <= set(seen[1])
    assert len(seen[2]) == len(brute([(k, t) for k, t in enumerate(seen[1])]))
    last = cp.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    coded = encoding.encode_ordinary_batch(seen[3])
    assert sorted((r.n_tokens, r.ids_sha256) for r in last) == sorted((len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for x in coded)
    assert sorted(r.decoded_sha256 for r in last) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in seen[3])


def test_all_queries_are_registered():
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{k}" for k in range(1, 11)]
    assert set(catalog.SQL) <= set(catalog.QUERIES)
