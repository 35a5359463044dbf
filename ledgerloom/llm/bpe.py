"""Byte-level BPE encoding and decoding with a transducer lexicon.

Spark counts the pre-tokens of all documents; the most frequent, ``lexicon`` at
most, are merged once and compiled into a minimal acyclic transducer with their ids as
outputs (``automaton``). Transducer, merge table and token bytes lie in one file
of flat arrays that Spark hands to every executor, where it is mapped into
memory. Inside Arrow batches the distinct pre-tokens of a few megabytes of text
walk the transducer together; those it does not know are merged exactly, all of
them side by side, and very long ones each with a heap.

The tokenizer's file is a parameter; it is read on the driver and its strings
of special tokens become their ids wherever they occur in a text.

Defined cases: NULL is an empty text, which has no ids; an empty table gives an
empty one and a transducer without words; ids outside the vocabulary decode to
nothing; rows are treated one by one; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import tempfile
import uuid
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import automaton
from ledgerloom.llm import words as W
from ledgerloom.llm.pretokens import Pretokens
from ledgerloom.llm.work import Work, ship_code

LEXICON = 32_768
#: Different pre-tokens that a task counts before it sends them on.
SPELLED = 1 << 17
#: Longer pre-tokens are neither in the lexicon nor merged side by side.
LONG = 96
_NONE = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if
    printable, else the next free one from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merge table and token bytes as arrays, from a tokenizer's JSON file."""

    def __init__(self, arrays: dict[str, np.ndarray], specials: dict[bytes, int]):
        self.arrays, self.specials = arrays, specials
        self.pattern = regex.compile(b"|".join(regex.escape(s) for s in sorted(specials, key=len, reverse=True))) if specials else None

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        described = json.loads(Path(path).read_text())
        ids = described["model"]["vocab"]
        letters = byte_letters()
        specials = {t["content"].encode(): t["id"] for t in described["added_tokens"]}
        known = {i: bytes(letters[c] for c in s) for s, i in ids.items()} | {i: s for s, i in specials.items()}
        token = [known.get(i, b"") for i in range(max(known) + 1)]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        left, right = (np.array([ids[p[k]] for p in pairs], np.int64) for k in (0, 1))
        order = np.argsort(left << 32 | right)
        sizes = np.array([len(t) for t in token], np.int64)
        byte_ids = {b: ids[c] for c, b in letters.items()}
        return cls(
            {
                "pair": (left << 32 | right)[order],
                "rank": np.arange(len(pairs))[order],
                "result": np.array([ids[a + b] for a, b in pairs], np.int64)[order],
                "byte_id": np.array([byte_ids[b] for b in range(256)], np.int64),
                "token_start": np.cumsum(sizes) - sizes,
                "token_size": sizes,
                "token_bytes": np.frombuffer(b"".join(token), np.uint8),
            },
            specials,
        )

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging neighbours; ``_NONE`` where none exists."""
        table, key = self.arrays["pair"], left << np.int64(32) | right
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        known = table[at] == key
        return np.where(known, self.arrays["rank"][at], _NONE), self.arrays["result"][at]

    def merged(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one after another, and how many each word has."""
        sizes = ends - starts
        counts = np.zeros(len(starts), np.int64)
        done_word, done_place, done_id = [], [], []
        short = np.flatnonzero(sizes <= LONG)
        for w in np.flatnonzero(sizes > LONG).tolist():
            own = self._long(data[starts[w]: ends[w]])
            done_word.append(np.full(len(own), w)), done_place.append(np.arange(len(own))), done_id.append(own)
        word = np.repeat(short, sizes[short])
        place = np.arange(len(word)) - np.repeat(np.cumsum(sizes[short]) - sizes[short], sizes[short])
        symbol = self.arrays["byte_id"][data[starts[word] + place]]
        rank, result = self._neighbours(symbol, word)
        while len(symbol):
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            best = np.minimum.reduceat(rank, head)
            counted = np.diff(np.append(head, len(word)))
            goes_on = np.repeat(best < _NONE, counted)
            if not goes_on.all():
                out = ~goes_on
                done_word.append(word[out]), done_place.append(place[out]), done_id.append(symbol[out])
                word, place, symbol, rank, result = (x[goes_on] for x in (word, place, symbol, rank, result))
                best, counted = best[best < _NONE], counted[best < _NONE]
                if not len(word):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, counted))
            hit = hit[np.append(True, word[hit[1:]] != word[hit[:-1]])]
            symbol[hit] = result[hit]
            stay = np.ones(len(word), bool)
            stay[hit + 1] = False
            moved = np.cumsum(stay) - 1
            word, place, symbol, rank, result = (x[stay] for x in (word, place, symbol, rank, result))
            for at in (moved[hit], moved[hit] - 1):
                at = at[at >= 0]
                inside = (at + 1 < len(word)) & (word[np.minimum(at + 1, len(word) - 1)] == word[at])
                rank[at[~inside]] = _NONE
                at = at[inside]
                rank[at], result[at] = self.pairs(symbol[at], symbol[at + 1])
        if not done_word:
            return np.zeros(0, np.int64), counts
        word, place, ids = map(np.concatenate, (done_word, done_place, done_id))
        order = np.lexsort((place, word))
        return ids[order], np.bincount(word, minlength=len(starts))

    def _neighbours(self, symbol: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, result = np.full(len(symbol), _NONE), np.zeros(len(symbol), np.int64)
        if len(symbol) > 1:
            rank[:-1], result[:-1] = self.pairs(symbol[:-1], symbol[1:])
            rank[:-1][word[:-1] != word[1:]] = _NONE
        return rank, result

    def _long(self, data: np.ndarray) -> np.ndarray:
        """One word by a heap of its pairs, for words of any length."""
        symbol = self.arrays["byte_id"][data].tolist()
        n = len(symbol)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        table = getattr(self, "_table", None)
        if table is None:
            keys, ranks, results = (self.arrays[k].tolist() for k in ("pair", "rank", "result"))
            table = self._table = {k: (r, x) for k, r, x in zip(keys, ranks, results, strict=True)}
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (found := table.get(symbol[i] << 32 | symbol[j])):
                heap.append((found[0], i, symbol[i], symbol[j], found[1]))

        for i in range(n - 1):
            offer(i)
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or symbol[i] != left or symbol[j] != right:
                continue
            symbol[i], alive[j], after[i] = new, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0:
                    size = len(heap)
                    offer(k)
                    if len(heap) > size:
                        heapq.heappush(heap, heap.pop())
        return np.array([s for s, a in zip(symbol, alive, strict=True) if a], np.int64)

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all tokens, one after another, and how many each has."""
        size = self.arrays["token_size"]
        known = (ids >= 0) & (ids < len(size))
        ids = np.where(known, ids, 0)
        sizes = np.where(known, size[ids], 0)
        shift = self.arrays["token_start"][ids] - (np.cumsum(sizes) - sizes)
        return self.arrays["token_bytes"][np.repeat(shift, sizes) + np.arange(sizes.sum())], sizes


def _save(path: Path, arrays: dict[str, np.ndarray]) -> dict[str, tuple[str, int, int]]:
    """All arrays in one file, and where each is: type, byte offset, length."""
    places, at = {}, 0
    with path.open("wb") as out:
        for name, array in arrays.items():
            out.write(b"\0" * (-at % 8))
            at += -at % 8
            places[name] = (array.dtype.str, at, len(array))
            out.write(array.tobytes())
            at += array.nbytes
    return places


class Codec:
    """The compiled tokenizer; pickled, it is the name of a file to map."""

    def __init__(self, file: str, places: dict[str, tuple[str, int, int]], specials: dict[bytes, int]):
        self.file, self.places, self.specials = file, places, specials
        self.vocabulary: Vocabulary | None = None

    def __getstate__(self):
        return self.file, self.places, self.specials

    def __setstate__(self, state):
        self.__init__(*state)

    def open(self) -> Codec:
        if self.vocabulary is None:
            flat = np.memmap(SparkFiles.get(self.file), np.uint8, "r")
            arrays = {n: np.frombuffer(flat, k, size, at) for n, (k, at, size) in self.places.items()}
            self.vocabulary = Vocabulary(arrays, self.specials)
        return self

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after another, and how many each text has."""
        vocabulary, pieces, owner, special = self.vocabulary, [], [], []
        for i, text in enumerate(texts):
            at = 0
            for found in vocabulary.pattern.finditer(text) if vocabulary.pattern and text else ():
                pieces.append(text[at: found.start()]), owner.append(i)
                special.append(vocabulary.specials[found.group()])
                at = found.end()
            pieces.append(text[at:] if text else b""), owner.append(i), special.append(-1)
        ids, counts = self._ids(pieces)
        special, owner = np.array(special, np.int64), np.array(owner, np.int64)
        ends = np.cumsum(counts)
        ids = np.insert(ids, ends[special >= 0], special[special >= 0])
        return ids, np.bincount(owner, counts + (special >= 0), len(texts)).astype(np.int64)

    def _ids(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        found, arrays = Pretokens(texts), self.vocabulary.arrays
        if not len(found.starts):
            return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
        hashes = W.Sums(found.data).of(found.starts, found.ends)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        starts, ends = found.starts[first], found.ends[first]
        number = automaton.look_up(arrays, found.data, starts, ends)
        new = np.flatnonzero(number < 0)
        fresh, sizes = self.vocabulary.merged(found.data, starts[new], ends[new])
        pool = np.concatenate((arrays["lexicon_ids"], fresh))
        at, size = np.zeros(len(first), np.int64), np.zeros(len(first), np.int64)
        old = number >= 0
        at[old], size[old] = arrays["lexicon_start"][number[old]], arrays["lexicon_size"][number[old]]
        at[new], size[new] = len(arrays["lexicon_ids"]) + np.cumsum(sizes) - sizes, sizes
        each = size[which]
        total = np.cumsum(each)
        ids = pool[np.repeat(at[which] - (total - each), each) + np.arange(total[-1])]
        return ids, np.bincount(found.doc, each, len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        data, sizes = self.vocabulary.decoded(ids)
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum(counts))]
        flat = data.tobytes()
        return [flat[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _count_pretokens(specials: dict[bytes, int]):
    def run(batches):
        splitter = Vocabulary({}, specials).pattern
        hashes, counts, spelled = [], [], {}

        def counted():
            key, which = np.unique(np.concatenate(hashes), return_inverse=True)
            total = np.bincount(which, np.concatenate(counts)).astype(np.int64)
            keys = key.tolist()
            for a in range(0, len(keys), 50_000):
                own = [spelled[k] for k in keys[a: a + 50_000]]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.binary()), pa.array(total[a: a + 50_000])], ["word", "n"])
            hashes.clear(), counts.clear(), spelled.clear()

        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                pieces = [p for t in texts[a:b] if t for p in (splitter.split(t) if splitter else (t,))]
                found = Pretokens(pieces)
                use = found.ends - found.starts <= LONG
                starts, ends = found.starts[use], found.ends[use]
                if not len(starts):
                    continue
                key, first, count = np.unique(W.Sums(found.data).of(starts, ends), return_index=True, return_counts=True)
                data = found.data.tobytes()
                for k, i in zip(key.tolist(), first.tolist(), strict=True):
                    if k not in spelled:
                        spelled[k] = data[starts[i]: ends[i]]
                hashes.append(key), counts.append(count)
                # What a task counts before it sends is bounded, whatever it reads.
                if len(spelled) >= SPELLED:
                    yield from counted()
        if hashes:
            yield from counted()

    return run


def _least(totals: DataFrame, lexicon: int) -> int:
    """A count that at most ``lexicon`` pre-tokens reach, to an eighth of an
    octave, from a histogram of a few hundred rows."""
    step = F.floor(8 * F.log2("n")).alias("step")
    sizes = totals.groupBy(step).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least"))
    least, seen = 1 << 62, 0
    for row in sorted(sizes.collect(), key=lambda r: -r["step"]):
        seen += row["words"]
        if seen > lexicon:
            break
        least = row["least"]
    return least


def compiled(documents: DataFrame, path: str, lexicon: int = LEXICON) -> Codec:
    """The tokenizer at ``path`` with the lexicon of ``documents``."""
    spark = documents.sparkSession
    ship_code(spark)
    vocabulary = Vocabulary.read(path)
    counted = documents.select("text").mapInArrow(_count_pretokens(vocabulary.specials), "word binary, n long")
    work = Work(spark, "bpe")
    totals = work.keep(counted.groupBy("word").agg(F.sum("n").alias("n")), "pretokens")
    words = sorted(bytes(r["word"]) for r in totals.filter(F.col("n") >= _least(totals, lexicon)).select("word").collect())
    work.drop(totals)
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    ids, counts = vocabulary.merged(np.frombuffer(b"".join(words), np.uint8), ends - sizes, ends)
    arrays = vocabulary.arrays | automaton.build(words)
    arrays |= {"lexicon_ids": ids, "lexicon_start": np.cumsum(counts) - counts, "lexicon_size": counts}
    file = Path(tempfile.mkdtemp(prefix="ledgerloom-bpe-")) / f"bpe-{uuid.uuid4().hex}.bin"
    places = _save(file, arrays)
    # The driver's file server hands the file to each executor.
    spark.sparkContext.addFile(str(file))
    return Codec(file.name, places, vocabulary.specials)


def _encode(codec: Codec, keys: tuple[str, ...]):
    def run(batches):
        own = codec.open()
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                ids, counts = own.encode(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(a, b - a) for k in keys), W.lists(ids.astype(np.int32), counts)],
                    [*keys, "ids"],
                )

    return run


def encoded(documents: DataFrame, path: str, lexicon: int = LEXICON) -> DataFrame:
    """Per document: doc_id, ids."""
    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(_encode(compiled(docs, path, lexicon), ("doc_id",)), "doc_id long, ids array<int>")


def _both(codec: Codec):
    def run(batches):
        own = codec.open()
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                ids, counts = own.encode(texts[a:b])
                back = [hashlib.sha256(x.encode()).hexdigest() for x in own.decode(ids, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(a, b - a), pa.array(counts), W.lists(ids.astype(np.int32), counts), pa.array(back)],
                    ["doc_id", "n_tokens", "ids", "decoded_sha256"],
                )

    return run


def encoded_and_decoded(documents: DataFrame, path: str, lexicon: int = LEXICON) -> DataFrame:
    """Per document: doc_id, n_tokens, ids, and the SHA-256 of the text that the
    ids decode to."""
    docs = documents.select("doc_id", "text")
    schema = "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string"
    return docs.mapInArrow(_both(compiled(docs, path, lexicon)), schema)


def _decode(codec: Codec):
    def run(batches):
        own = codec.open()
        for batch in batches:
            lists = batch.column("ids")
            counts = np.array([len(x) if x is not None else 0 for x in lists], np.int64)
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(own.decode(ids, counts), pa.string())], ["doc_id", "text"]
            )

    return run


def decoded(codes: DataFrame, codec: Codec) -> DataFrame:
    """Per row of (doc_id, ids): doc_id, text."""
    return codes.select("doc_id", "ids").mapInArrow(_decode(codec), "doc_id long, text string")


def _round_trip(codec: Codec):
    def run(batches):
        own = codec.open()
        for batch in batches:
            texts = W.texts_of(batch.column("text"))
            for a, b in W.slices(texts):
                ids, counts = own.encode(texts[a:b])
                back = own.decode(ids, counts)
                ends = np.cumsum(counts)
                raw = [ids[e - c: e].astype("<u4").tobytes() for c, e in zip(counts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        pa.array(counts),
                        pa.array([hashlib.sha256(x).hexdigest() for x in raw]),
                        pa.array([hashlib.sha256(x.encode()).hexdigest() for x in back]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def round_trip(documents: DataFrame, path: str, lexicon: int = LEXICON) -> DataFrame:
    """Encode and decode each document: doc_id, n_tokens, and digests of ids and text."""
    docs = documents.select("doc_id", "text")
    return docs.mapInArrow(
        _round_trip(compiled(docs, path, lexicon)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op10_bpe(documents: DataFrame) -> DataFrame:
    import public_tokenizers

    return round_trip(documents, public_tokenizers.path("byte_bpe_50k.json"))
