"""BPE encoding and decoding with a lexicon of the corpus's frequent words.

Spark counts the words of all documents. The most frequent are merged once and compiled with their ids into a minimal
acyclic transducer, which tasks map into memory. A task looks a word up there and merges it by rank only if it is
not in it, so that the result never depends on the lexicon.
"""

from __future__ import annotations

import gc
import heapq
import json
import uuid
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docpulse.llm.common import query, stored, table
from docpulse.llm.lexicon import Lexicon, build
from docpulse.session import shared_dir

PIECE = 1 << 21  # characters handled at a time within an Arrow batch
KEPT = 400_000  # chunks a task remembers
IDS = 20  # bits of an id; a pair's rank stands above the id it merges into
NONE = 1 << 62


class WordBpe:
    """The tokenizer a file of the tokenizers library describes: BPE with word ends, as ``word_bpe_49k.json``."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None:
            raise ValueError("not a word BPE with NFC, white space and lower case normalised")
        self.end, self.vocab = model["end_of_word_suffix"], model["vocab"]
        self.rank = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.vocab[a], self.vocab[b]] = r << IDS | self.vocab[a + b]
        self.token = {i: t for t, i in self.vocab.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token |= {i: t for t, i in self.special.items()}
        pairs = sorted((a << IDS | b, value) for (a, b), value in self.rank.items())
        self.pairs, self.values = (np.array(c, np.int64) for c in zip(*pairs))
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split["pattern"]["Regex"], regex.V0).findall
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.plain = regex.compile(r"[^\x1c-\x1fİ̀-\U0010ffff]*+").fullmatch
        # bytes are written as printable characters: those that are ones already, then others from U+0100 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        chars = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.inner = [self.vocab[chars[b]] for b in range(256)]
        self.last = [self.vocab[chars[b] + self.end] for b in range(256)]
        self.library = Tokenizer.from_str(text)

    def chunks(self, text: str) -> list[str]:
        """Normalised pieces between white space, which no word crosses.

        Below U+0300 every character is NFC and is lowered alone. Beyond, what a character is depends on the version of
        Unicode: there the library normalises, which makes white space of any kind one space, and splits.
        """
        if self.plain(text):
            return text.lower().split()
        return self.library.normalizer.normalize_str(text).split(" ")

    def words(self, chunk: str) -> list[str]:
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk]
            if chunk[:-1].isalpha() and chunk[-1] in ",.":
                return [chunk[:-1], chunk[-1]]
        if self.plain(chunk):
            return self.find(chunk)
        return [chunk[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(chunk)]

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the pair of lowest rank is merged, the leftmost first, until none is left."""
        s = [self.inner[b] for b in word]
        s[-1] = self.last[word[-1]]
        if len(s) > 200:
            return self._merge_long(s)
        rank = self.rank.get
        ranks = [rank(pair, NONE) for pair in zip(s, s[1:])]
        while ranks and (best := min(ranks)) != NONE:
            i = ranks.index(best)
            s[i:i + 2] = [best & ((1 << IDS) - 1)]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((s[i - 1], s[i]), NONE)
            if i < len(ranks):
                ranks[i] = rank((s[i], s[i + 1]), NONE)
        return s

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        wanted = a << IDS | b
        at = np.minimum(np.searchsorted(self.pairs, wanted), len(self.pairs) - 1)
        return np.where(self.pairs[at] == wanted, self.values[at], NONE)

    def merge_many(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of many words: those of one length are merged together, a pair of each at a time."""
        by_size, out = defaultdict(list), {}
        for w in words:
            by_size[len(w)].append(w)
        inner, last = np.array(self.inner), np.array(self.last)
        for size, own in by_size.items():
            if size > 48 or len(own) < 8:
                out.update((w, self.merge(w)) for w in own)
                continue
            own = np.array(own, dtype=object)
            data = np.frombuffer(b"".join(own), np.uint8).reshape(-1, size)
            s = inner[data]
            s[:, -1] = last[data[:, -1]]
            r = self._ranks(s[:, :-1], s[:, 1:])
            while len(own):
                n, size = s.shape
                each, at = np.arange(n), r.argmin(1) if size > 1 else np.zeros(n, np.int64)
                best = r[each, at] if size > 1 else np.full(n, NONE)
                more = best != NONE
                out.update(zip(own[~more].tolist(), s[~more].tolist()))
                own, s, r, at, best = own[more], s[more], r[more], at[more], best[more]
                each, column = np.arange(len(own)), np.arange(size)
                s = np.take_along_axis(s, column[None, :-1] + (column[:-1] > at[:, None]), 1)
                s[each, at] = best & ((1 << IDS) - 1)
                r = np.take_along_axis(r, column[None, :-2] + (column[:-2] >= at[:, None]), 1)
                i = np.flatnonzero(at > 0)
                r[i, at[i] - 1] = self._ranks(s[i, at[i] - 1], s[i, at[i]])
                i = np.flatnonzero(at < size - 2)
                r[i, at[i]] = self._ranks(s[i, at[i]], s[i, at[i] + 1])
        return out

    def _merge_long(self, s: list[int]) -> list[int]:
        """The same with a heap of pairs over linked symbols, for words of any length."""
        left, right = list(range(-1, len(s) - 1)), list(range(1, len(s) + 1))
        right[-1] = -1
        heap = [(self.rank[p], i, p) for i, p in enumerate(zip(s, s[1:])) if p in self.rank]
        heapq.heapify(heap)
        while heap:
            best, i, pair = heapq.heappop(heap)
            j = right[i]
            if s[i] is None or j < 0 or (s[i], s[j]) != pair:
                continue
            s[i], s[j], right[i] = best & ((1 << IDS) - 1), None, right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (s[a], s[b]) in self.rank:
                    heapq.heappush(heap, (self.rank[s[a], s[b]], a, (s[a], s[b])))
        return [x for x in s if x is not None]

    def segments(self, text: str) -> Iterator[tuple[int | None, str]]:
        """(id, "") for a special token, (None, text) for what is between."""
        for i, part in enumerate(self.specials.split(text) if self.specials and "<" in text else [text]):
            if i % 2:
                yield self.special[part], ""
            elif part:
                yield None, part


def gather(flat: array, starts: array, numbers: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The parts of ``flat`` between ``starts`` that have the numbers, one after the other, and their sizes."""
    taken, begin = np.array(numbers, np.int64), np.array(starts)
    sizes = begin[taken + 1] - begin[taken]
    ends = np.cumsum(sizes)
    place = np.repeat(begin[taken] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
    return np.array(flat, np.int32)[place], sizes


class Encoder:
    """Encodes with a lexicon and remembers chunks between white space: each has a number, at which its ids and their tokens are kept."""

    def __init__(self, bpe: WordBpe, lexicon: Lexicon | None):
        self.bpe, self.lexicon = bpe, lexicon
        self._turn()
        self._turn()

    def _turn(self) -> None:
        """Begin a new memory; what the one before knows is taken over when it is met again."""
        self.older = (self.seen, self.flat, self.starts, self.shown) if hasattr(self, "seen") else ({}, array("i"), array("q", [0]), [])
        self.seen, self.flat, self.starts, self.shown, self.silent = {}, array("i"), array("q", [0]), [], set()

    def _put(self, chunks: list[str | int], ids: np.ndarray, sizes: np.ndarray, shown: list[str]) -> None:
        """Remember chunks that are not known yet: ``sizes`` of the ``ids`` belong to each."""
        first = len(self.shown)
        self.seen.update(zip(chunks, range(first, first + len(chunks))))
        self.starts.frombytes((len(self.flat) + np.cumsum(sizes, dtype=np.int64)).tobytes())
        self.flat.frombytes(np.ascontiguousarray(ids, np.int32).tobytes())
        self.shown += shown
        self.silent.update((first + np.flatnonzero(sizes == 0)).tolist())

    def _show(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        tokens, ends = list(map(self.bpe.token.__getitem__, ids.tolist())), np.cumsum(sizes).tolist()
        return [tokens[a] if b - a == 1 else " ".join(tokens[a:b]) for a, b in zip([0, *ends], ends)]

    def _known(self, chunks: Iterable[str]) -> list[str]:
        """Takes over what the memory before knows and gives the other chunks."""
        seen, flat, starts, shown = self.older
        numbers = [(c, seen.get(c)) for c in chunks]
        held = [(c, k) for c, k in numbers if k is not None]
        if held:
            taken = [k for _, k in held]
            self._put([c for c, _ in held], *gather(flat, starts, taken), [shown[k] for k in taken])
        return [c for c, k in numbers if k is None]

    def learn(self, chunks: set[str | int]) -> None:
        """Ids of chunks not seen yet: their words are looked up, those not found are merged together."""
        words = self.bpe.words
        special = [c for c in chunks if isinstance(c, int)]
        if special:
            ids = np.array(special)
            self._put(special, ids, np.ones(len(ids), np.int64), self._show(ids, np.ones(len(ids), np.int64)))
        spelled = {c: words(c) for c in self._known(c for c in chunks if isinstance(c, str))}
        seen = self.seen
        new = self._known({w for own in spelled.values() for w in own if w not in seen})
        coded = [w.encode() for w in new]
        if self.lexicon and new:
            found, ids, sizes = self.lexicon.get_many(coded)
            self._put([w for w, f in zip(new, found) if f], ids, sizes, self._show(ids, sizes))
            new = [w for w, f in zip(new, found) if not f]
            coded = [w.encode() for w in new]
        merged = self.bpe.merge_many(coded)
        lists = [merged[w] for w in coded]
        sizes = np.array(list(map(len, lists)), np.int64)
        ids = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        self._put(new, ids, sizes, self._show(ids, sizes))
        rest = [(c, list(map(seen.__getitem__, own))) for c, own in spelled.items() if len(own) != 1 or own[0] != c]
        if rest:
            counts = np.array([len(own) for _, own in rest], np.int64)
            ids, sizes = gather(self.flat, self.starts, list(chain.from_iterable(own for _, own in rest)))
            ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
            shown = self.shown.__getitem__
            self._put([c for c, _ in rest], ids, np.diff(ends), [" ".join(map(shown, own)) for _, own in rest])

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        ids, ends, _ = self.code_all(texts)
        return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]

    def code_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts one after the other, where each text's begin and the last end, and the texts the ids give."""
        if len(self.seen) > KEPT or len(self.flat) > 16 * KEPT:
            self._turn()
        lists = []
        for text in texts:
            chunks = []
            for special, part in self.bpe.segments(text):
                if special is not None:
                    chunks.append(special)
                else:
                    chunks += self.bpe.chunks(part)
            lists.append(chunks)
        number = self.seen.get
        numbers = [list(map(number, chunks)) for chunks in lists]
        unknown = {c for chunks, own in zip(lists, numbers) if None in own for c, k in zip(chunks, own) if k is None}
        if unknown:
            self.learn(unknown)
            numbers = [list(map(number, chunks)) if None in own else own for chunks, own in zip(lists, numbers)]
        silent = self.silent
        if silent:
            numbers = [own if silent.isdisjoint(own) else [k for k in own if k not in silent] for own in numbers]
        counts = list(map(len, numbers))
        ids, sizes = gather(self.flat, self.starts, list(chain.from_iterable(numbers)))
        texts_end = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
        shown = self.shown.__getitem__
        decoded = [" ".join(map(shown, own)) for own in numbers]
        for chunk in unknown:
            if isinstance(chunk, str) and len(chunk) > 64:  # long ones are rare and would fill the memory
                self.seen.pop(chunk, None)
        return ids, texts_end, decoded

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space: such a file names no decoder."""
        return " ".join(map(self.bpe.token.__getitem__, ids))


def pieces(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(start, texts) of ``PIECE`` characters or one text at least, so that memory is bounded."""
    start, texts, n = 0, [], 0
    for i, value in enumerate(column):
        texts.append(value.as_py() or "")
        n += len(texts[-1])
        if n >= PIECE:
            yield start, texts
            start, texts, n = i + 1, [], 0
    if texts:
        yield start, texts


@contextmanager
def collector_off() -> Iterator[None]:
    """Many small lasting objects without circles: looking for circles among them would cost a third of the time."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


def word_counts(docs: DataFrame, spec, text_col: str = "text") -> DataFrame:
    """word, n over all texts; ``spec`` is a broadcast tokenizer file. Tasks count before the shuffle."""

    def count(batches):
        bpe, chunks = WordBpe(spec.value), Counter()
        with collector_off():
            for batch in batches:
                for _, texts in pieces(batch.column(0)):
                    for text in texts:  # what only the full normalisation tells is left out: the lexicon need not be exact
                        chunks.update(text.lower().split())
                    if len(chunks) > KEPT:
                        yield words(bpe, chunks)
                        chunks = Counter()
            yield words(bpe, chunks)

    def words(bpe, chunks):
        found = Counter()
        for chunk, n in chunks.items():
            if len(chunk) <= 64:
                for word in bpe.words(chunk):
                    found[word] += n
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(found.values(), pa.int64())], ["word", "n"])

    return (docs.select(text_col).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(counts: DataFrame, most: int) -> list[bytes]:
    """At most ``most`` words, all that are frequent enough: a histogram of 8 steps per doubling gives the least count."""
    counts = stored(counts.filter("n > 1").withColumn("step", F.floor(F.log2("n") * 8).cast("int")), "words")
    least, total = None, 0
    for row in counts.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > most:
            break
        least = row["step"]
    if least is None:
        return []
    return sorted(r.word.encode() for r in counts.filter(F.col("step") >= least).select("word").collect())


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           lexicon_words: int = 1 << 16) -> DataFrame:
    """One row per document: its id, ``ids`` array<int> and ``decoded``, the text the ids give.

    ``tokenizer`` is the path of the tokenizer file on the driver. The most frequent words of at most 64 characters,
    ``lexicon_words`` or fewer, make the lexicon, which bounds what is sent to the tasks; it has no effect on the
    result. NULL and empty texts have no ids and decode to "". Repeated rows and NULL ids are kept as they are. Other
    columns are not read. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        text = file.read()
    spec, bpe = spark.sparkContext.broadcast(text), WordBpe(text)
    frequent = frequent_words(word_counts(docs, spec, text_col), lexicon_words)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/docpulse-llm/{name}")
    file = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    file.write(bytearray(build((w, bpe.merge(w)) for w in frequent)))
    file.close()
    spark.sparkContext.addFile(path.toString())

    def run(batches):
        encoder = Encoder(WordBpe(spec.value), Lexicon(SparkFiles.get(name)))
        with collector_off():
            for batch in batches:
                for start, texts in pieces(batch.column(1)):
                    ids, ends, decoded = encoder.code_all(texts)
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).slice(start, len(texts)), lists, pa.array(decoded, pa.string())], [id_col, "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Length and SHA-256 of what ``encode`` gives."""
    return encoded.select(
        id_col, F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query()
def op5_bpe(spark, sf_dir):
    """All texts encoded and decoded."""
    return digests(encode(table(spark, sf_dir, "documents"), tokenizer_path()))
