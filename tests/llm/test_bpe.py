import hashlib
import random

import pytest

from tallyforge.llm import bpe

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=bpe.pattern(), mergeable_ranks=bpe.load_ranks(bpe.vocabulary_path()), special_tokens={})


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_ids_are_those_of_the_library(odd, odd_rows, encoding, most):
    """With all pieces in the dictionary, and with none."""
    rows = odd.dropDuplicates(["text"])
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    coded = bpe.encode(rows, most=most)
    for r in bpe.digests(coded).collect():
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize(("most", "apart", "memo"), [(2_000_000, False, 100), (0, True, 1000)])
def test_digests_of_texts(odd, encoding, most, apart, memo):
    rows = odd.dropDuplicates(["text"])
    texts = {r.doc_id: r.text or "" for r in rows.collect()}
    for r in bpe.token_digests(rows, memo, apart, most).collect():
        ids = encoding.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_white_space(spark, encoding):
    rng = random.Random(5)
    alphabet = ["a", "Bc", " ", "  ", "\n", "\t", " ", "　", "'s", "'ll", "1", "12", ".", "é", "日本", "🙂", "<|endoftext|>"]
    rows = [(k, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 25)))) for k in range(400)]
    got = {r.doc_id: r.ids for r in bpe.encode(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {k: ",".join(map(str, encoding.encode_ordinary(t))) for k, t in rows}


def test_native_decoding(spark, encoding):
    rows = [(1, "Plain words, and naïve 日本語 🙂"), (2, ""), (3, None)]
    out = bpe.encode(spark.createDataFrame(rows, "doc_id bigint, text string"))
    got = {r.doc_id: bytes(r.x).decode() for r in out.select("doc_id", bpe.decode(out["ids"]).alias("x")).collect()}
    assert got == {k: t or "" for k, t in rows}


def test_heap_merge_of_long_pieces(encoding):
    rng = random.Random(6)
    ranks = bpe.load_ranks(bpe.vocabulary_path())
    for n in (1, 2, 50, 3000):
        piece = "".join(rng.choice("abcde") for _ in range(n))
        assert bpe.heap_merge(piece.encode(), ranks) == encoding.encode_ordinary(piece)


def test_words_by_stem_and_ending():
    """A word's pieces are its stem's and what it ends in; letters alone are one piece."""
    rng, split = random.Random(7), bpe.Splitter(bpe.pattern())
    assert split.stem("word***") == "word" and split.stem("***") == "***"
    alphabet = ["a", "Bc", "é", "日本", "1", "½", "'", "'s", "'ll", ".", "**", "_", "\t", "🙂", "\u0301", "\u2160"]
    for _ in range(20_000):
        w = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 7)))
        stem = split.stem(w)
        for lead in (" ", ""):
            assert split.pieces(lead, stem) + split.find(w[len(stem) :]) == split.find(lead + w), (lead, w)
    whole = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letters = "".join(c for c in whole if c.isalpha())
    assert split.find(letters) == [letters]  # no letter of Python's is none of the pattern's
    for c in (c for c in whole if c.isalnum()):
        assert split.find(f"{c}.") == [c, "."]


def test_pieces_counted_by_stem_and_ending(spark, odd, odd_rows):
    """Counts are those of the pattern over whole texts."""
    from collections import Counter

    split, ranks = bpe.Splitter(bpe.pattern()), bpe.load_ranks(bpe.vocabulary_path())
    texts = [r[1] or "" for r in odd_rows] + ["Stop... (or go!) it's.", "ab*** ab*** ab cd***\nab***"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r.piece: r.n for r in bpe.count_pieces(docs, bpe.pattern(), spark.sparkContext.broadcast(ranks), 50).collect()}
    assert got == {p: n for p, n in Counter(p for t in texts for p in split.find(t)).items() if p.encode() not in ranks}


def test_table_of_pairs():
    """Each pair of tokens that makes a token, and no other; small, as it goes with each stage that folds and stays in the driver."""
    table, ranks = bpe.pair_table(bpe.vocabulary_path()), bpe.load_ranks(bpe.vocabulary_path())
    assert sum(map(len, table.values())) < 500_000
    token, rng = {r: t for t, r in ranks.items()}, random.Random(8)
    known = list(token)
    pairs = [(rng.choice(known), rng.choice(known)) for _ in range(5_000)]
    pairs += [(ranks[t[:k]], ranks[t[k:]]) for t in rng.sample(list(ranks), 3_000) for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    for a, b in pairs:
        at = int(table["base"][a]) + b
        both = int(table["pair"][at]) if 0 <= at < len(table["pair"]) else -1
        got = both & (1 << bpe.ID_BITS) - 1 if both >> bpe.ID_BITS == a else None
        assert got == ranks.get(token[a] + token[b]), (a, b)


def test_empty(empty):
    assert bpe.digests(bpe.encode(empty)).count() == 0
