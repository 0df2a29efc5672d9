"""Byte-level BPE encoding and decoding with the ranks of a public vocabulary.

A piece (a match of the vocabulary's pattern) is encoded by Spark's higher-order functions: the ids of
its bytes are an array, and a fold merges the adjacent pair of least rank until none has a rank. Ranks
are looked up in a literal map from pairs of ids to the merged id, its rank: the rows of the map, one for
each first id, are laid over each other in one array, as a map's entries are searched one by one.

Pieces are counted over all texts. The most frequent ones, up to a documented bound, are encoded
once and broadcast as sorted hashes, checksums and ids;
the distinct pieces of a document beyond them are encoded in its own row. So texts are never
shuffled, and nothing that is broadcast grows with the corpus. Decoding joins the ids' byte strings.

Defined results: a null text counts as empty; an empty text has no ids; pieces of more than
``LONG`` bytes are merged by a heap in Python, as the fold is quadratic in a piece's length;
repeated rows are encoded each; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import json
import string
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_bounds, release, text_or_empty, written

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
DICTIONARY = 1_000_000  # pieces that are broadcast, at most
DICTIONARY_BYTES = 64  # of a broadcast piece, at most
MEMO = 150_000  # words that a task remembers, at most; more where it has the memory
LONG = 256
PUNCTUATION = string.punctuation
ID_BITS, PLACE_BITS = 21, 12  # of an id, and of a place in a piece
NO_PAIR = 1 << 54  # above any pair's rank


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@lru_cache(4)
def load_ranks(path: str) -> dict[bytes, int]:
    """Byte string to rank of each token of a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def heap_merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long piece, in n log n: the pairs wait in a heap by rank and place."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, after, before = list(range(1, n + 1)), list(range(1, n + 1)), list(range(-1, n - 1))
    live = [True] * n
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) < n and (r := ranks.get(piece[i : end[j]])) is not None:
            heapq.heappush(heap, (r, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, e = heapq.heappop(heap)
        if not live[i] or after[i] >= n or end[after[i]] != e:
            continue
        j = after[i]
        live[j], end[i], after[i] = False, e, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(before[i])
        offer(i)
    return [ranks[piece[i : end[i]]] for i in range(n) if live[i]]


@lru_cache(2)
def pair_table(path: str) -> dict:
    """The ranks of pairs of tokens as arrays, rows laid over each other: where ``pair[base[a] + b]`` holds a above its
    ``ID_BITS`` low bits, a and b merge into what these hold. ``byte``: the ids of single bytes; ``two``: ranks of pairs of bytes, -1 for none."""
    import numpy as np

    ranks = load_ranks(path)
    rows: dict[int, dict[int, int]] = {}
    for token, rank in ranks.items():
        for k in range(1, len(token)):
            a, b = ranks.get(token[:k]), ranks.get(token[k:])
            if a is not None and b is not None:
                rows.setdefault(a, {})[b] = rank
    ids = max(ranks.values()) + 1
    spread = 1 << max(8, (2 * sum(map(len, rows.values()))).bit_length())
    own, rank_of, base = np.full(spread + ids, -1, np.int32), np.zeros(spread + ids, np.int32), np.full(ids, -2 * ids, np.int32)
    rng = np.random.default_rng(3)
    for a in sorted(rows, key=lambda a: (-len(rows[a]), a)):
        columns = np.fromiter(rows[a], int)
        while True:  # at most half full: a few draws do
            offsets = rng.integers(0, spread, 32)
            free = (own[offsets[:, None] + columns] < 0).all(1)
            if free.any():
                break
        base[a] = offsets[free.argmax()]
        own[base[a] + columns], rank_of[base[a] + columns] = a, list(rows[a].values())
    byte = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
    two = np.array([ranks.get(bytes([i, j]), -1) for i in range(256) for j in range(256)], np.int32)
    pair = np.where(own < 0, -1, (own.astype(np.int64) << ID_BITS) + rank_of)
    return {"base": base, "pair": pair, "byte": byte, "two": two}


def rank_literal(path: str) -> Column:
    """The arrays of ``pair_table`` as a literal struct."""
    text = ",".join(f'"{k}":[{",".join(map(str, v.tolist()))}]' for k, v in pair_table(path).items())
    return F.from_json(F.lit(f"{{{text}}}"), "struct<base:array<int>,pair:array<bigint>,byte:array<int>,two:array<int>>")


def _bind(value: Column, f) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def encode_piece(piece: Column, literal: Column) -> Column:
    """The ids of a piece of one byte at least that is no token itself, as decimal numbers joined by commas.

    The piece's bytes, as ids of tokens, are an array with a mark before it; each knows the rank of the
    pair that it begins. Each step of the fold merges the first pair of least rank; the id of a merged
    token is the pair's rank."""
    return _bind(literal, lambda table: _encoded(piece, table))


def _encoded(piece: Column, table: Column) -> Column:
    """A token of the fold is one number: the rank of the pair that it begins (``NO_PAIR`` for none), its place and its id,
    so that the least number is the first pair of least rank."""
    rest, low, ids = F.lit(1 << 30), F.lit((1 << PLACE_BITS + ID_BITS) - 1), F.lit((1 << ID_BITS) - 1)
    none, places = F.lit(NO_PAIR), F.lit((1 << PLACE_BITS + ID_BITS) - (1 << ID_BITS))
    id_of = lambda x: x.bitwiseAND(ids).cast("int")
    ranked = lambda r: F.shiftleft(r.cast("bigint"), PLACE_BITS + ID_BITS)

    def pair(a: Column, b: Column) -> Column:
        both = F.get(table["pair"], F.get(table["base"], a) + b)
        return F.when(F.shiftright(both, ID_BITS) == a, F.shiftleft(both.bitwiseAND(ids), PLACE_BITS + ID_BITS)).otherwise(none)

    def merged(s: Column, m: Column, k: Column) -> Column:
        """s with its token k, which is m, and the one after it as one token."""
        t, before = F.shiftright(m, PLACE_BITS + ID_BITS).cast("int"), F.get(s, k - 2)
        two = F.array(
            pair(id_of(before), t).bitwiseOR(before.bitwiseAND(low)),
            pair(t, id_of(F.get(s, k + 1))).bitwiseOR(m.bitwiseAND(places)).bitwiseOR(t),
        )
        return F.concat(F.slice(s, F.lit(1), k - 2), two, F.slice(s, k + 2, rest))

    def step(s: Column, _: Column) -> Column:
        return _bind(F.array_min(s), lambda m: F.when(m >= none, s).otherwise(_bind(F.array_position(s, m).cast("int"), lambda k: merged(s, m, k))))

    def fold(octets: Column) -> Column:
        def first(x: Column, i: Column) -> Column:
            r = F.get(table["two"], x * 256 + F.get(octets, i + 1))
            return F.when(r >= 0, ranked(r)).otherwise(none).bitwiseOR(F.shiftleft((i + 1).cast("bigint"), ID_BITS)).bitwiseOR(F.get(table["byte"], x).cast("bigint"))

        start = F.concat(F.array(F.lit(NO_PAIR | (1 << ID_BITS) - 1)), F.transform(octets, first))  # a mark, then the bytes
        return F.aggregate(F.sequence(F.lit(2), F.size(octets)), start, step, lambda s: F.array_join(F.transform(F.slice(s, F.lit(2), rest), lambda x: id_of(x).cast("string")), ","))

    octets = F.transform(F.split(F.decode(F.encode(piece, "UTF-8"), "ISO-8859-1"), ""), lambda c: F.ascii(c))
    return _bind(octets, fold)


class Splitter:
    """Splits texts into pieces; most texts by lines and spaces first, as a word is met again and again.

    Where no space or line feed stands beside other white space, no piece reaches over one of them but
    with the one space before it, and a line feed is a piece of its own: the pieces of a line's first
    word, and those of `` word``, are the same in any text. By the public pattern a word of letters is one piece with the
    space before it, and punctuation that ends a word is a piece of its own."""

    def __init__(self, pat: str):
        import regex

        self.find, self.mixed = regex.compile(pat).findall, regex.compile(r"[ \n]\s|\s[ \n]").search
        self.public = pat == pattern()

    def pieces(self, lead: str, word: str) -> list[str]:
        """Of a word with a space before it (``lead``), or of a line's first."""
        return [lead + word] if self.public and word.isalpha() else self.find(lead + word)

    def stem(self, word: str) -> str:
        """The word without the punctuation that it ends in, if that is a piece of its own; else the word."""
        stem = word.rstrip(PUNCTUATION)
        return stem if self.public and stem[-1:].isalnum() else word

    def lines(self, text: str) -> list[list[str]] | None:
        """Words of the lines; all but a line's first have a space before them. None: split the text whole."""
        one = text.replace("\n", " ")
        if " ".join(one.split()) != one:  # runs of white space, or other than space and line feed
            if self.mixed(text) or text[:1] == "\n" or text[-1:] in ("\n", " "):
                return None
        return [line.split(" ") for line in text.split("\n")]


class Dictionary:
    """Ids of known pieces: sorted hashes, for each a checksum and where its ids lie. ``first``: where the hashes with
    the same leading bits begin, about one each."""

    def __init__(self, hashes: bytes, checks: bytes, at: bytes, ids: bytes):
        import numpy as np

        known = np.frombuffer(hashes, np.uint64)
        self.n, bits = len(known), max(1, len(known).bit_length())
        self.shift = 64 - bits
        self.first = memoryview(np.searchsorted(known, np.arange(1 << bits, dtype=np.uint64) << np.uint64(self.shift)).astype(np.int32))
        self.hashes = memoryview(np.append(known, np.uint64((1 << 64) - 1)))  # a search ends there
        self.checks, self.at, self.ids = memoryview(checks).cast("I"), memoryview(at).cast("i"), ids

    def get(self, piece: bytes) -> str | None:
        """The piece's ids, if it is known."""
        import xxhash

        h, hashes = xxhash.xxh64_intdigest(piece, 42), self.hashes
        i = self.first[h >> self.shift]
        while hashes[i] < h:
            i += 1
        if i == self.n or hashes[i] != h or self.checks[i] != zlib.crc32(piece):
            return None
        return str(self.ids[self.at[i] : self.at[i + 1]], "ascii")


def count_pieces(docs: DataFrame, pat: str, ranks, memo: int = MEMO) -> DataFrame:
    """(piece, n) over all texts, of pieces that are no token: words are counted in each task, and split when their
    counts have met. ``ranks`` is a broadcast."""
    arrow_bounds(docs.sparkSession)

    def count(batches):
        from collections import Counter

        import pyarrow as pa

        split, words, firsts, pieces = Splitter(pat), Counter(), Counter(), Counter()

        def out():
            for n in (words, firsts):
                for w in [w for w in n if not w.isalnum()]:
                    stem = split.stem(w)
                    if len(stem) != len(w):
                        k = n.pop(w)
                        n[stem] = n.get(stem, 0) + k
                        firsts[w[len(stem) :]] += k
            for lead, n in ((" ", words), ("", firsts), (None, pieces)):  # pieces are as they are
                if n:
                    yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([lead] * len(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["x", "lead", "n"])
                    n.clear()

        for batch in batches:
            for text in batch.column(0).to_pylist():
                lines = split.lines(text)
                if lines is None:
                    pieces.update(split.find(text))
                else:
                    if len(lines) > 1:
                        pieces["\n"] += len(lines) - 1
                    for line in lines:
                        firsts[line[0]] += 1
                        words.update(line[1:])
                if len(words) + len(firsts) + len(pieces) > 2 * memo:
                    yield from out()
        yield from out()
        release()

    def parts(batches):
        import pyarrow as pa

        split, known = Splitter(pat), ranks.value
        for batch in batches:
            x, n = [], []
            for a, lead, k in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = [p for p in ([a] if lead is None else split.pieces(lead, a)) if p.encode() not in known]
                x += found
                n += [k] * len(found)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.string()), pa.array(n, pa.int64())], ["piece", "n"])

    counts = docs.select(text_or_empty().alias("text")).mapInArrow(count, "x string, lead string, n bigint").groupBy("x", "lead").agg(F.sum("n").alias("n"))
    return counts.mapInArrow(parts, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))


def dictionary(docs: DataFrame, literal: Column, pat: str, ranks, most: int = DICTIONARY, memo: int = MEMO) -> tuple[bytes, bytes, bytes, bytes]:
    """Of the most frequent pieces (those of at least the least count that stays within the bound): hashes,
    checksums, places and ids."""
    import numpy as np

    pieces = written(count_pieces(docs, pat, ranks, memo).where(F.octet_length("piece") <= DICTIONARY_BYTES), "pieces")
    level = F.floor(F.log2("n") * 16).cast("int")
    least, seen = None, 0
    for row in sorted(pieces.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"]):
        seen += row["count"]
        if seen > most:
            break
        least = row["level"]
    if least is None:
        return b"", b"", np.zeros(1, np.int32).tobytes(), b""
    cores = docs.sparkSession.sparkContext.defaultParallelism
    # at most the bound's number of short pieces: their hashes and ids fit in the driver
    known = pieces.where(level >= least).select("piece").repartition(4 * cores)
    found = known.select(F.xxhash64("piece").alias("h"), F.crc32(F.col("piece").cast("binary")).alias("c"), encode_piece(F.col("piece"), literal).alias("ids")).toArrow()
    h = found.column(0).to_numpy().view(np.uint64)
    order = np.argsort(h, kind="stable")
    ids = found.column(2).take(order).combine_chunks()
    _, at, data = ids.buffers()
    places = np.frombuffer(at, np.int32, len(ids) + 1, ids.offset * 4)
    return h[order].tobytes(), found.column(1).to_numpy()[order].astype(np.uint32).tobytes(), (places - places[0]).tobytes(), data.to_pybytes()[places[0] : places[-1]]


def looked_up(docs: DataFrame, path: str | None, pat: str | None, most: int, key: str, memo_size: int) -> DataFrame:
    """(key, stream, rest): each text's ids joined by commas, and the ids of its pieces beyond the dictionary, for which
    ``#`` and their number stand in the stream."""
    path, pat = path or vocabulary_path(), pat or pattern()
    spark, literal = docs.sparkSession, rank_literal(path)
    spark.conf.set("spark.sql.maxPlanStringLength", "100000")  # or each plan's description holds the literal
    release()
    ranks = spark.sparkContext.broadcast(load_ranks(path))  # a vocabulary
    known = spark.sparkContext.broadcast(dictionary(docs, literal, pat, ranks, most, memo_size))
    release()
    arrow_bounds(spark)
    kind = dict(docs.dtypes)[key]

    def look_up(batches):
        """Ids of the known pieces; ``#`` and a number stand for one of the row's other pieces."""
        import pyarrow as pa

        split, pieces, tokens = Splitter(pat), Dictionary(*known.value), ranks.value
        memos: dict[str, dict[str, str]] = {" ": {}, "": {}}  # of words with a space before them, and of lines' first words and what words end in
        memo = memos[" "]

        def piece(x: str, other: dict[str, str]) -> str:
            raw = x.encode()
            if (rank := tokens.get(raw)) is not None:
                return str(rank)
            if (got := pieces.get(raw)) is not None:
                return got
            return ",".join(map(str, heap_merge(raw, tokens))) if len(raw) > LONG else other.setdefault(x, f"#{len(other)}")

        def of(found: list[str], other: dict[str, str]) -> str:
            return ",".join([piece(x, other) for x in found])

        def word(lead: str, w: str, other: dict[str, str]) -> str:
            """Ids of a word, by those of its stem and what it ends in."""
            if (got := memos[lead].get(w)) is not None:
                return got
            if split.public and w.isalpha():
                got = piece(lead + w, other)
            elif len(stem := split.stem(w)) != len(w):
                return f"{word(lead, stem, other)},{word('', w[len(stem) :], other)}"
            else:
                got = of(split.find(lead + w), other)
            if "#" not in got:
                if len(memo) + len(memos[""]) >= memo_size:
                    memo.clear()
                    memos[""].clear()
                memos[lead][w] = got
            return got

        for batch in batches:
            stream, rest = [], []
            for text in batch.column(1).to_pylist():
                other: dict[str, str] = {}
                lines = split.lines(text)
                if lines is None:
                    stream.append(of(split.find(text), other))
                else:
                    out = []
                    for line in lines:
                        if out:
                            out.append(word("", "\n", other))
                        if line[0]:
                            out.append(word("", line[0], other))
                        ids = list(map(memo.get, line[1:]))
                        if None in ids:
                            ids = [word(" ", line[i], other) if x is None else x for i, x in enumerate(ids, 1)]
                        out += ids
                    stream.append(",".join(out))
                rest.append(list(other))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(stream, pa.string()), pa.array(rest, pa.list_(pa.string()))], [key, "stream", "rest"])
        memo.clear()
        memos[""].clear()
        release()

    rows = docs.select(key, text_or_empty().alias("text")).mapInArrow(look_up, f"`{key}` {kind}, stream string, rest array<string>")
    return rows.withColumn("rest", F.transform("rest", lambda w: encode_piece(w, literal)))


def encode(docs: DataFrame, path: str | None = None, pat: str | None = None, most: int = DICTIONARY, key: str = "doc_id", memo: int = MEMO) -> DataFrame:
    """(key, ids): each text's ids as decimal numbers joined by commas."""
    rows = looked_up(docs, path, pat, most, key, memo)
    filled = F.array_join(F.transform(F.split("stream", ","), lambda x: F.when(F.substring(x, 1, 1) == "#", F.get(F.col("rest"), F.substring(x, F.lit(2), F.lit(9)).cast("int"))).otherwise(x)), ",")
    return rows.select(key, F.when(F.size("rest") == 0, F.col("stream")).otherwise(filled).alias("ids"))


def digests(rows: DataFrame, path: str | None = None, key: str = "doc_id") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256) of rows (key, ids), or (key, stream, rest) as ``looked_up`` returns
    them; decoding joins the ids' binary pieces."""
    pieces = rows.sparkSession.sparkContext.broadcast({str(r): t for t, r in load_ranks(path or vocabulary_path()).items()})
    arrow_bounds(rows.sparkSession)

    def finish(batches):
        import re

        import pyarrow as pa

        token, sha, mark = pieces.value.__getitem__, hashlib.sha256, re.compile(r"#(\d+)").sub
        for batch in batches:
            n, ids_hash, text_hash = [], [], []
            rest = batch.column(2).to_pylist() if batch.num_columns > 2 else [()] * batch.num_rows
            for ids, more in zip(batch.column(1).to_pylist(), rest, strict=True):
                if more:
                    ids = mark(lambda m, more=more: more[int(m[1])], ids)
                tokens = ids.split(",") if ids else []
                n.append(len(tokens))
                ids_hash.append(sha(ids.encode()).hexdigest())
                text_hash.append(sha(b"".join(map(token, tokens))).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(text_hash, pa.string())], [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    columns = [key, "ids"] if "ids" in rows.columns else [key, "stream", "rest"]
    return rows.select(*columns).mapInArrow(finish, f"`{key}` {dict(rows.dtypes)[key]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def token_digests(docs: DataFrame, memo: int = MEMO, apart: bool = False, most: int = DICTIONARY, key: str = "doc_id") -> DataFrame:
    """``digests`` of docs. ``apart``: the ids are written between, which takes disk and leaves a task one Python worker."""
    rows = looked_up(docs, None, None, most, key, memo)
    return digests(written(rows, "ids") if apart else rows, key=key)


def decode(ids: Column, path: str | None = None) -> Column:
    """The bytes that a column of comma-joined ids stands for, by a literal table of hexadecimal pieces."""
    ranks = load_ranks(path or vocabulary_path())
    token: list[str] = [""] * (max(ranks.values()) + 1)
    for t, r in ranks.items():
        token[r] = t.hex()
    table = F.from_json(F.lit(json.dumps(token)), "array<string>")
    pieces = F.transform(F.filter(F.split(ids, ","), lambda x: x != ""), lambda x: F.get(table, x.cast("int")))
    return F.unhex(F.array_join(pieces, ""))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of ``documents``."""
    return token_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), memo=600_000)
