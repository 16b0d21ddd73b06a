"""BPE encoding and decoding with a minimal acyclic transducer as lexicon.

The lexicon holds the words that are most frequent in the corpus, counted by Spark over all texts, and the whole words of
the vocabulary, with their token ids. It is compiled on the driver into a shared-suffix automaton whose transitions carry word counts, so that the path of a word spells
its rank, and the rank finds its ids (the id outputs). Spark ships the file to every executor, where the workers
memory-map it. Words that the automaton does not accept are merged exactly, in rank order, long ones by a heap of their
pairs, so that a run of any length takes n log n steps. What the lexicon holds changes no result.

Defined results: a null text is an empty one, an empty text has no ids and decodes to the empty text; equal texts have
equal values; repeated rows are kept; a null doc_id is kept; an empty table gives an empty result; any text and any word is
encoded whole; other columns, whatever their names, are ignored. Classes and lower
case of characters are those of this Python's Unicode version; newer characters may differ from other implementations.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import mmap
import os
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import drop_table, materialise, scratch_path, tidy, write_bytes

VOCABULARY = "word_bpe_49k.json"
END = "</w>"
#: Entries of a worker's memos of white-space words and of pre-tokens; a memo is emptied when full.
MEMO = 300_000
#: Words of the corpus that the lexicon holds at most, and letters of such a word at most.
FREQUENT, LONGEST = 1 << 16, 40
#: Pre-tokens of more letters are merged by a heap.
SHORT = 48


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class Transducer:
    """A read-only automaton over byte labels: ``rank(word)`` is the word's place in sorted order, or -1.

    States are runs of arcs in parallel tables: label, first arc and number of arcs of the target, count of words before
    the arc, and word end. Outputs are runs of ids found by rank.
    """

    MAGIC = b"MADT2\0\0\0"

    def __init__(self, buffer) -> None:
        view = memoryview(buffer)
        self.n_arcs, self.n_words, self.n_ids, self.root, self.start_final, self.root_width = struct.unpack_from("<6I", view, 8)
        at = 8 + 24
        self.skip, at = view[at : at + 4 * self.n_arcs].cast("I"), at + 4 * self.n_arcs
        self.target, at = view[at : at + 4 * self.n_arcs].cast("I"), at + 4 * self.n_arcs
        self.offset, at = view[at : at + 4 * (self.n_words + 1)].cast("I"), at + 4 * (self.n_words + 1)
        self.ids, at = view[at : at + 4 * self.n_ids].cast("I"), at + 4 * self.n_ids
        self.width, at = view[at : at + 2 * self.n_arcs].cast("H"), at + 2 * self.n_arcs
        self.final, at = view[at : at + self.n_arcs], at + self.n_arcs
        self.find = bytes(view[at : at + self.n_arcs]).find  # a label is one byte; the other tables stay where they are

    def rank(self, word: bytes) -> int:
        skip, target, width, ends, find = self.skip, self.target, self.width, self.final, self.find
        arc, wide, found, final = self.root, self.root_width, 0, self.start_final
        for byte in word:
            i = find(byte, arc, arc + wide)
            if i < 0:
                return -1
            found += skip[i] + (1 if final else 0)  # a word that ends here comes before longer ones
            final, arc, wide = ends[i], target[i], width[i]
        return found if final else -1

    def get(self, word: bytes) -> list[int] | None:
        at = self.rank(word)
        return None if at < 0 else self.ids[self.offset[at] : self.offset[at + 1]].tolist()


def compile_lexicon(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """The bytes of a minimal ``Transducer``: words are added in order, and suffix states are shared as they close."""
    words = sorted(dict(entries).items())
    register: dict[tuple, int] = {}
    arcs: list[tuple[int, int, int, int]] = []  # label, target run, words before, word end
    runs: list[tuple[int, int, int]] = [(0, 0, 0)]  # first arc, arcs and words of a run; run 0 has none

    def close(node: list) -> int:
        """The run of an equal finished state; node: [final, [(label, final, run)...]]"""
        key = tuple(node[1])
        if not key:
            return 0
        if key not in register:
            first, before = len(arcs), 0
            for label, final, run in key:
                arcs.append((label, run, before, final))
                before += final + runs[run][2]
            runs.append((first, len(key), before))
            register[key] = len(runs) - 1
        return register[key]

    path: list[list] = [[0, []]]
    last = b""

    def shut(depth: int) -> None:
        while len(path) - 1 > depth:
            node = path.pop()
            path[-1][1].append((last[len(path) - 1], node[0], close(node)))

    start_final = 0
    for word, _ in words:
        if not word:
            start_final = 1
            continue
        common = len(os.path.commonprefix([last, word]))
        shut(common)
        path.extend([0, []] for _ in word[common:])
        path[-1][0], last = 1, word
    shut(0)
    root, root_width, _ = runs[close(path[0])]
    offsets, ids = [0], []
    for _, out in words:
        ids += out
        offsets.append(len(ids))
    pack = lambda kind, xs: struct.pack(f"<{len(xs)}{kind}", *xs)
    return b"".join((
        Transducer.MAGIC, struct.pack("<6I", len(arcs), len(words), len(ids), root, start_final, root_width),
        pack("I", [a[2] for a in arcs]), pack("I", [runs[a[1]][0] for a in arcs]), pack("I", offsets), pack("I", ids),
        pack("H", [runs[a[1]][1] for a in arcs]), bytes(a[3] for a in arcs), bytes(a[0] for a in arcs),
    ))


class Model:
    """Vocabulary and merges of a word-end BPE file, and the exact merge."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], special: dict[str, int]) -> None:
        self.vocab, self.special = vocab, special
        self.ranks = {tuple(pair): k for k, pair in enumerate(merges)}
        self.letters = byte_letters()
        self.tokens = {v: k for k, v in vocab.items()} | {v: k for k, v in special.items()}

    @classmethod
    def load(cls, path: str) -> Model:
        spec = json.loads(open(path, encoding="utf-8").read())
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in special}
        return cls(vocab, [tuple(m) for m in spec["model"]["merges"]], special)

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-token by exact merges: the lowest rank first, leftmost among equals."""
        parts = [self.letters[b] for b in word]
        parts[-1] += END
        if len(parts) > SHORT:
            return [self.vocab[p] for p in self._merged(parts) if p in self.vocab]
        rank, none = self.ranks.get, 1 << 30
        ranks = [rank(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) != none:
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), none)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), none)
        return [self.vocab[p] for p in parts if p in self.vocab]

    def _merged(self, parts: list[str | None]) -> list[str]:
        """The same over a linked list, with the pairs in a heap by rank and place."""
        rank, n = self.ranks.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if (r := rank((a, b))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:  # one of the two was merged since
                continue
            parts[i], parts[j], after[i] = a + b, None, after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := rank((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p in parts if p is not None]

    def whole_words(self) -> Iterator[tuple[bytes, list[int]]]:
        """The vocabulary's whole words with the ids that the merges give them."""
        back = {c: b for b, c in enumerate(self.letters)}
        for token in self.vocab:
            if token.endswith(END) and len(token) > len(END):
                word = bytes(back[c] for c in token[: -len(END)])
                yield word, self.merge(word)


# White space as the vocabulary's normaliser sees it: Unicode's, without the separators U+001C to U+001F.
_SPLIT = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_ODD = re.compile("[\x1c-\x1f]")


@functools.cache
def _piece_pattern() -> re.Pattern:
    import regex

    return regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def _whole(word: str) -> bool:
    """Whether the word is one pre-token."""
    return _piece_pattern().fullmatch(word) is not None


class Encoder:
    """Encodes and decodes texts with a model and its lexicon; results of white-space words are memoised."""

    def __init__(self, model: Model, lexicon: Transducer) -> None:
        self.model, self.lexicon = model, lexicon
        self.pattern = _piece_pattern()
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(model.special, key=len, reverse=True))) + ")") if model.special else None
        self.marks = tuple({s[:2] for s in model.special})
        self.memo: dict[str, tuple[str, int, str]] = {}
        self.pieces: dict[str, tuple[str, int, str]] = {}

    def word(self, word: str) -> tuple[str, int, str]:
        """(ids, their number, decoded tokens) of a word without white space."""
        if word.isascii():  # in its own normal form
            low = word.lower()
            if word.isalpha():
                return self.pieces.get(low) or self.piece(low)
        else:
            low = unicodedata.normalize("NFC", word).replace("\u03a3", "\u03c3").lower()
        found = [self.pieces.get(p) or self.piece(p) for p in self.pattern.findall(low)]
        if len(found) == 1:
            return found[0]
        ids, numbers, tokens = zip(*found) if found else ((), (), ())
        return " ".join(ids), sum(numbers), " ".join(tokens)

    def piece(self, piece: str) -> tuple[str, int, str]:
        """A pre-token: by the lexicon, else by exact merges."""
        raw = piece.encode()
        if len(self.pieces) >= MEMO:
            self.pieces.clear()
        out = self.pieces[piece] = self.shown(self.lexicon.get(raw) or self.model.merge(raw))
        return out

    def shown(self, ids: list[int]) -> tuple[str, int, str]:
        return " ".join(map(str, ids)), len(ids), " ".join(map(self.model.tokens.__getitem__, ids))

    def text(self, text: str) -> list[tuple[str, int, str]]:
        """The parts of a text in order; a part without ids is left out."""
        if self.specials and any(m in text for m in self.marks):
            parts = []
            for k, span in enumerate(self.specials.split(text)):
                parts += [self.shown([self.model.special[span]])] if k % 2 else self.plain(span)
            return parts
        return self.plain(text)

    def plain(self, text: str) -> list[tuple[str, int, str]]:
        words = text.split() if not _ODD.search(text) else [w for w in _SPLIT.split(text) if w]
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        for w in set(words).difference(memo):
            memo[w] = self.word(w)
        return [memo[w] for w in words]

    def ids(self, text: str) -> list[int]:
        return [int(i) for part in self.text(text) if part[1] for i in part[0].split(" ")]

    def decode(self, ids: Iterable[int]) -> str:
        return " ".join(self.model.tokens[i] for i in ids if i in self.model.tokens)

    def digests(self, text: str) -> tuple[int, str, str]:
        parts = self.text(text)
        ids, numbers, tokens = zip(*parts) if parts else ((), (), ())
        if 0 in numbers:  # words that leave nothing
            ids, tokens = ([x for x, n in zip(column, numbers) if n] for column in (ids, tokens))
        return sum(numbers), hashlib.sha256(" ".join(ids).encode()).hexdigest(), hashlib.sha256(" ".join(tokens).encode()).hexdigest()


_open: dict[str, Encoder] = {}
_shipped: set[tuple[str, str]] = set()


def _encoder(name: str, model) -> Encoder:
    """This worker's encoder; the lexicon stays on disk, mapped, and is shared by the workers of an executor."""
    if name not in _open:
        with open(SparkFiles.get(name), "rb") as f:
            mapped = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        _open[name] = Encoder(Model(*model.value), Transducer(mapped))
    return _open[name]


def ship(spark: SparkSession, path: str, frequent: Iterable[str] = ()) -> tuple[str, object]:
    """Compile the lexicon of a vocabulary file and hand it to Spark: (file name, broadcast model).

    ``frequent``: further words, already normalised, to hold besides the vocabulary's own: some MB, whatever the corpus.
    """
    model = Model.load(path)
    entries = dict(model.whole_words())
    entries.update((w.encode(), model.merge(w.encode())) for w in frequent if w)
    data = compile_lexicon(entries.items())
    name = f"lexicon-{hashlib.sha256(data).hexdigest()[:16]}.madt"
    if (place := (spark.sparkContext.applicationId, name)) not in _shipped:
        spark.sparkContext.addFile(write_bytes(spark, f"{scratch_path(spark, 'lexicon')}/{name}", data))
        _shipped.add(place)
    merges = [pair for pair, _ in sorted(model.ranks.items(), key=lambda x: x[1])]
    return name, spark.sparkContext.broadcast((model.vocab, merges, model.special))


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def frequent_words(docs: DataFrame, most: int = FREQUENT) -> list[str]:
    """The most frequent normalised words of all whole texts, up to ``most`` of ``LONGEST`` letters, as pre-tokens.

    Words are counted in parts before they are shuffled. Counts of counts tell from which count on ``most`` words or fewer are
    left, so that the driver gets no more than these, from however many tasks.
    """
    words = docs.select(F.explode(F.split(F.lower("text"), " ")).alias("word")).where(F.length("word").between(2, LONGEST))
    counts = materialise(words.groupBy("word").agg(F.count("*").alias("n")).where("n > 1"), "bpe-words")
    steps = F.floor(F.log2("n") * 16).cast("int")  # classes of counts, some hundred in all
    classes = sorted((r["step"], r["words"]) for r in counts.groupBy(steps.alias("step")).agg(F.count("*").alias("words")).collect())
    least, total = None, 0
    for step, size in reversed(classes):
        if total + size > most:
            break
        least, total = step, total + size
    found = [] if least is None else counts.where(steps >= least).select("word").collect()
    drop_table(docs.sparkSession, counts)
    plain = sorted(unicodedata.normalize("NFC", r["word"]) for r in found)
    return [w for w in plain if w.isalpha() and w == w.lower() and _whole(w)]


def encode(docs: DataFrame, path: str | None = None, frequent: Iterable[str] | None = None, ids: bool = True) -> DataFrame:
    """``docs`` keys with token_ids (if ``ids``), n_tokens, ids_sha256 and decoded_sha256 of every whole text; ``frequent`` words are counted if not given."""
    words = frequent_words(docs) if frequent is None else frequent
    name, model = ship(docs.sparkSession, path or default_vocabulary(), words)

    @tidy
    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, model)
        for batch in found:
            column = batch.column("text")
            for at in range(0, batch.num_rows, 512):
                texts = [x or "" for x in column.slice(at, 512).to_pylist()]
                n, a, b = zip(*map(encoder.digests, texts))
                out = [batch.column("doc_id").slice(at, 512), pa.array(n, pa.int64()), pa.array(a), pa.array(b)]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if ids:
                    out.append(pa.array([encoder.ids(t) for t in texts], pa.list_(pa.int32())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(out, names)
        encoder.memo.clear()
        encoder.pieces.clear()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * ids
    return docs.select("doc_id", "text").mapInArrow(batches, schema)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the text that ``token_ids`` decode to (tokens joined by a space, as the vocabulary has no decoder)."""
    name, model = ship(tokens.sparkSession, path or default_vocabulary())

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, model)
        for batch in found:
            texts = [encoder.decode(x or []) for x in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "token_ids").mapInArrow(batches, "doc_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), ids=False)
