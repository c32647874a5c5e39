"""Token-ID files: Simple-8b words in blocks, written and read by Spark.

A corpus becomes numbered binary files of records in ascending key order. A record (little-endian) holds whole documents:

    "BL8B", documents, blocks, words, escapes (uint32 each), ids (uint64)
    keys (int64 per document), is the key null (uint8 per document), ids of each document (uint64)
    word offset of every block and the number of words (uint32, blocks + 1)
    words (uint64), escapes (uint64), one byte 0x0A

A block is ``BLOCK`` ids (the last of a record may be shorter) and starts on a word, so the offsets let a reader decode any block
alone. The upper 4 bits of a word select how many ids of how many bits its other 60 bits hold, the first id in the lowest bits.
Selector 0 marks an escape: the word holds the position, among the escapes of the record, of an id of more than 60 bits.

Files are written by Spark's text sink (a record is a row, 0x0A its end mark) and read by its binary source, so any store that Spark
reaches will do, and lost or repeated tasks leave no part of a file behind.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brightloom.session import measured

BLOCK = 4096
# Ids per word and bits per id for the selectors 0 (escape) to 15.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (60, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
_HEAD = "<4s4IQ"
_MAGIC = b"BL8B"
_COUNT = np.array(COUNTS, np.int64)


def _windows(fits: np.ndarray, n: int) -> np.ndarray:
    """For every place of a row: do the ``n`` places from it on all fit? Doubles the reach of each place until it is ``n``."""
    have = 1
    while have < n:
        more = min(have, n - have)
        fits = fits[:, :-more] & fits[:, more:]
        have += more
    return fits


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(words, offsets, escapes)`` of unsigned ids: every word takes as many of the next ids of its block as fit.

    Which selectors can stand at a place is found for all places at once; following the words is done for all blocks at once.
    """
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    blocks = -(-n // block)
    padded = np.full(blocks * block, np.iinfo(np.uint64).max, np.uint64)  # fits nowhere, so no word reaches over an end
    padded[:n] = ids
    rows = padded.reshape(blocks, block)
    choice = np.zeros(rows.shape, np.uint8)  # escape, unless a selector fits
    for s in range(len(COUNTS) - 1, 0, -1):
        if COUNTS[s] <= block:
            fits = _windows(rows < np.uint64(1 << WIDTHS[s]), COUNTS[s])
            np.copyto(choice[:, : fits.shape[1]], np.uint8(s), where=fits)
    flat = choice.ravel()
    step = _COUNT[flat]
    starts = np.zeros(len(flat), bool)
    ends = np.minimum(np.arange(block, len(flat) + block, block), n)
    at = ends - block if not n % block else np.append(ends[:-1] - block, (blocks - 1) * block)
    while len(at):
        starts[at] = True
        at = at + step[at]
        on = at < ends
        at, ends = at[on], ends[on]
    first = np.flatnonzero(starts)
    used = flat[first]
    words = used.astype(np.uint64) << np.uint64(60)
    for s in range(2, len(WIDTHS)):
        mine = np.flatnonzero(used == s)
        if len(mine):
            at, bits = first[mine], words[mine]
            for j in range(COUNTS[s]):
                bits |= padded[at + j] << np.uint64(WIDTHS[s] * j)
            words[mine] = bits
    mine = np.flatnonzero(used == 0)
    words[mine] |= np.arange(len(mine), dtype=np.uint64)
    offsets = np.append(np.searchsorted(first, np.arange(0, n, block)), len(words)).astype(np.uint32)
    return words, offsets, padded[first[mine]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of a run of whole words, all words of a selector at a time."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = _COUNT[selector]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(selector):
        rows = np.flatnonzero(selector == s)
        if s == 0:
            out[first[rows]] = escapes[(words[rows] & np.uint64((1 << 60) - 1)).astype(np.int64)]
        elif s > 1:
            mask = np.uint64((1 << WIDTHS[s]) - 1)
            for j in range(COUNTS[s]):
                out[first[rows] + j] = (words[rows] >> np.uint64(WIDTHS[s] * j)) & mask
    return out


def make_record(keys: Sequence[int | None], lengths: Sequence[int], ids: np.ndarray) -> bytes:
    """One record without its end byte."""
    words, offsets, escapes = pack(ids)
    null = np.array([k is None for k in keys], np.uint8)
    known = np.array([0 if k is None else k for k in keys], np.int64)
    head = struct.pack(_HEAD, _MAGIC, len(known), len(offsets) - 1, len(words), len(escapes), len(ids))
    return b"".join((head, known.tobytes(), null.tobytes(), np.array(lengths, np.uint64).tobytes(), offsets.tobytes(), words.tobytes(), escapes.tobytes()))


class Record:
    """A parsed record; ids are decoded on demand."""

    def __init__(self, data: memoryview, at: int):
        magic, docs, blocks, words, escapes, self.n_ids = struct.unpack_from(_HEAD, data, at)
        if magic != _MAGIC:
            raise ValueError(f"no record at byte {at}")
        self.end = at + struct.calcsize(_HEAD)

        def take(kind, count):
            part = np.frombuffer(data, kind, count, self.end)
            self.end += part.nbytes
            return part

        known, null = take(np.int64, docs), take(np.uint8, docs)
        self.keys = [None if x else int(k) for k, x in zip(known, null)]
        self.lengths = take(np.uint64, docs).astype(np.int64)
        self.offsets, self.words, self.escapes = take(np.uint32, blocks + 1), take(np.uint64, words), take(np.uint64, escapes)
        if data[self.end : self.end + 1] != b"\n":
            raise ValueError(f"record without an end mark at byte {self.end}")
        self.end += 1

    def ids(self) -> np.ndarray:
        return unpack(self.words, self.escapes)

    def block(self, i: int) -> np.ndarray:
        """The ids of one block, read through its offset."""
        return unpack(self.words[self.offsets[i] : self.offsets[i + 1]], self.escapes)


def records(content: bytes | memoryview) -> Iterator[Record]:
    """The records of one file in order."""
    data, at = memoryview(content), 0
    while at < len(data):
        record = Record(data, at)
        at = record.end
        yield record


# No piece of the byte-level split pattern reaches over a single blank between two of these: it ends before the blank or starts with
# it. A line end after one of these ends a piece as well.
_PLAIN = frozenset(map(chr, [*range(33, 127), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_CUT = re.compile("(?<=[!-~À-ÖØ-öø-ÿ])(?= [!-~À-ÖØ-öø-ÿ])")
# A letter and one of these marks are never in one piece, unless a token is added to the vocabulary that holds them.
_LETTERS = frozenset(c for c in _PLAIN if c.isalpha())
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")
_NEW, _ODD = -1, -2


class TextEncoder:
    """Ids of whole texts by a ``tokenizers`` file, each different word of the texts encoded once.

    Texts are cut only before single blanks between two visible Latin characters, before line ends after one, and between a letter
    and the marks that end its word. The byte-level pattern of the tokenizer starts a new piece at each of them wherever it
    stands, so the ids of a text are those of its pieces. Other tokenizers take texts whole. An instance is broadcast and keeps its pieces for all tasks of a worker; beyond ``most`` it keeps
    those that several runs of texts had (none if they are too many).
    """

    def __init__(self, spec: str, special_text: bool = False, most: int = 450_000):
        self.spec, self.special_text, self.most = spec, special_text, most
        split = json.loads(spec)
        own = split.get("pre_tokenizer") or {}
        plain = split.get("normalizer") is None and own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space")
        added = [t["content"] for t in split.get("added_tokens") or ()]
        self.cuts = plain and not any(c.isspace() for t in added for c in t)
        self.marks = "".join(m for m in _MARKS if not any(x.isalpha() and y == m for t in added for x, y in zip(t, t[1:])))
        self.tokenizer = None

    def __getstate__(self) -> dict:
        return {k: getattr(self, k) for k in ("spec", "special_text", "most", "cuts", "marks")} | {"tokenizer": None}

    def _load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(self.spec)
        self.tokenizer.encode_special_tokens = self.special_text
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)  # does the id's text start with a blank?
        self.opens[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True
        self.line_end = vocabulary.get("Ċ", -1)
        self._forget()

    def _forget(self) -> None:
        """No pieces: ``words`` numbers those with one blank before them, if they do not start with a line end (``_ODD``: they cannot
        be cut off), ``exact`` all others."""
        self.words: dict[str, int] = {}
        self.exact: dict = {}
        self.start, self.size, self.ids, self.runs = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32), np.zeros(0, np.int32)

    def _forget_rare(self) -> None:
        """Only pieces that more than one run of texts had."""
        kept = np.flatnonzero(self.runs > 1)
        if len(kept) > self.most // 2:
            return self._forget()
        number = np.full(len(self.runs), -1)
        number[kept] = np.arange(len(kept))
        number = number.tolist()
        ids, sizes = self._gather(kept)
        self.words, self.exact = ({p: number[i] for p, i in of.items() if i >= 0 and number[i] >= 0} for of in (self.words, self.exact))
        self.start, self.size, self.ids, self.runs = np.cumsum(sizes) - sizes, sizes, ids, self.runs[kept]

    def _encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())), sizes

    def _add(self, to: dict, pieces: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        to.update(zip(pieces, range(len(self.size), len(self.size) + len(pieces))))
        self.start = np.append(self.start, len(self.ids) + np.cumsum(sizes) - sizes)
        self.size, self.ids = np.append(self.size, sizes), np.append(self.ids, ids)
        self.runs = np.append(self.runs, np.zeros(len(sizes), np.int32))

    def _gather(self, numbers: Sequence[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of numbered pieces in a row, and how many each has."""
        at = np.array(numbers, np.int64)
        sizes = self.size[at]
        stops = np.cumsum(sizes)
        return self.ids[np.repeat(self.start[at] - (stops - sizes), sizes) + np.arange(int(sizes.sum()))], sizes

    def _learn_exact(self, pieces: Iterable[str]) -> None:
        if new := [p for p in pieces if p not in self.exact]:
            self._add(self.exact, new, *self._encode(new))

    def _learn_words(self, seen: Iterable[str], run: int = 2000) -> None:
        """Runs of words are encoded as one text; an id that opens with a blank or line end starts the next word.

        A word that ends in marks after a letter is that word without them, and the marks.
        """
        new, lines, ended = [], [], {}
        for w in seen:
            if w[-1:] not in _PLAIN or w[0] not in _PLAIN and w[0] != "\n":
                self.words[w] = _ODD
                continue
            base = w.rstrip(self.marks)
            if base != w and base[-1:] in _LETTERS:
                ended[w] = base
            else:
                (lines if w[0] == "\n" else new).append(w)
        for base in set(ended.values()).difference(self.words, new, lines):
            (lines if base[0] == "\n" else new).append(base)
        whole = [w for w in lines if self.line_end < 0 or w.count("\n") > 1 or w[1] not in _PLAIN]
        lines = [w for w in lines if self.line_end >= 0 and w.count("\n") == 1 and w[1] in _PLAIN]
        for pieces, before in ((new, " "), (lines, "")):
            if pieces:
                ids, _ = self._encode([before + before.join(pieces[i : i + run]) for i in range(0, len(pieces), run)])
                first = np.flatnonzero(self.opens[ids] if before else ids == self.line_end)
                if len(first) != len(pieces):
                    raise ValueError("the tokenizer does not start a piece at every blank and line end")
                self._add(self.words, pieces, ids, np.diff(first, append=len(ids)))
        if whole:
            self._add(self.words, whole, *self._encode(whole))
        if ended:
            tails = [w[len(base) :] for w, base in ended.items()]
            self._learn_exact(set(tails))
            ids, sizes = self._gather([i for base, tail in zip(ended.values(), tails) for i in (self.words[base], self.exact[tail])])
            self._add(self.words, list(ended), ids, sizes[::2] + sizes[1::2])

    def __call__(self, texts: Sequence[str] | pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts in a row, ``end_id`` after each, and how many ids each has.

        Splitting and numbering the words of all texts is Arrow's work; only different words become Python strings.
        """
        if self.tokenizer is None:
            self._load()
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        if not self.cuts:
            ids, sizes = self._encode(texts.to_pylist())
            return np.insert(ids, np.cumsum(sizes), end_id), sizes + 1
        if len(self.words) + len(self.exact) > self.most:
            self._forget_rare()
        # a line end begins a word of its own, or goes on with the line ends before it
        split = pc.split_pattern(pc.replace_substring(pc.replace_substring(texts, "\n", " \n"), "\n \n", "\n\n"), " ")
        offsets = split.offsets.to_numpy()
        firsts, counts = (offsets - offsets[0])[:-1], np.diff(offsets)
        flat = split.flatten().dictionary_encode()
        different, index = flat.dictionary.to_numpy(zero_copy_only=False).tolist(), flat.indices.to_numpy()
        number = np.fromiter(map(self.words.get, different, repeat(_NEW)), np.int64, len(different))
        unknown = np.flatnonzero(number == _NEW)
        missing = [different[i] for i in unknown.tolist()]
        self._learn_words(missing)
        number[unknown] = list(map(self.words.__getitem__, missing))
        self.runs[number[number >= 0]] += 1
        numbers = number[index]
        # the first piece has no blank before it; a text with odd words is cut where it can be
        odd = np.add.reduceat(numbers == _ODD, firsts) > 0
        whole = {i: _CUT.split(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        heads = [different[i] for i in index[firsts[~odd]].tolist()]
        self._learn_exact({*heads, *chain.from_iterable(whole.values())})
        numbers[firsts[~odd]] = list(map(self.exact.__getitem__, heads))
        if whole:
            parts = np.split(numbers, firsts[1:])
            for i, pieces in whole.items():
                parts[i] = np.fromiter(map(self.exact.__getitem__, pieces), np.int64, len(pieces))
                counts[i] = len(pieces)
            numbers = np.concatenate(parts)
        if end_id not in self.exact:
            self._add(self.exact, [end_id], np.array([end_id], np.uint32), np.ones(1, np.int64))
        ends = np.cumsum(counts)
        numbers = np.insert(numbers, ends, self.exact[end_id])
        ids, sizes = self._gather(numbers)
        return ids, np.add.reduceat(sizes, ends - counts + np.arange(len(ends)))


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end_id: int = 2, file_chars: int = 1 << 24,
    record_chars: int = 1 << 21, special_text: bool = False,
) -> None:
    """Encode every whole text and write the ids, ``end_id`` after each document, to files below ``path`` in ascending key order.

    ``tokenizer`` is the path of a ``tokenizers`` file that the driver reads; its vocabulary travels with the job. Files take about
    ``file_chars`` characters of documents that follow each other in the order, so their number grows with the corpus. A null
    text is empty and has the end id alone; null keys come first; rows with equal keys follow the order they are read
    in, are all kept and may lie in several files. An empty table gives files without records. ``special_text`` encodes the names of
    special tokens inside a text as ordinary text. Other columns are ignored.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        encoder = spark.sparkContext.broadcast(TextEncoder(f.read(), special_text))
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("k"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    size = rows.agg(F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("n")).first()["n"]
    # Rows of one key are dealt by their position too, so that no key fills a file; the split points need no text.
    order = [F.col("k"), F.col("p")]
    rows = rows.withColumn("p", F.monotonically_increasing_id())
    sorted_rows = rows.repartitionByRange(max(1, -(-size // file_chars)), *order).sortWithinPartitions(*order).select("k", "t")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # runs of whole texts of about `record_chars` bytes
            ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy())
            run = np.maximum(ends - 1, 0) // record_chars  # empty texts at the front are in the first run
            starts = np.flatnonzero(np.diff(run, prepend=-1)).tolist()
            for first, last in zip(starts, [*starts[1:], batch.num_rows]):
                part = batch.slice(first, last - first)
                ids, lengths = encoder.value(part.column(1), end_id)
                record = make_record(part.column(0).to_pylist(), lengths, ids)
                yield pa.RecordBatch.from_arrays([pa.array([record], pa.binary())], ["record"])

    sorted_rows.mapInArrow(encode, "record binary").select(F.col("record").cast("string").alias("value")).write.option("lineSep", "\n").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files below ``path``: ``(file, number, key, start_in_file, ids)``.

    ``file`` grows with the order of the files and ``number`` counts the documents of a file; ``ids`` are 32-bit unsigned
    little-endian integers. A file is decoded record by record; the columns are all read from the files.
    """
    files = spark.read.format("binaryFile").load(path)
    name = F.element_at(F.split("path", "/"), -1)
    # A task of the writer has one file or, if the session limits rows per file, several numbered ones.
    place = [F.regexp_extract(name, r"part-(\d+)", 1).cast("long"), F.regexp_extract(name, r"-c(\d+)", 1).cast("long")]
    files = files.filter(F.length("content") > 0).select((place[0] * F.lit(1_000_000) + place[1]).alias("file"), "content")

    def decode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for file, content in zip(frame["file"], frame["content"]):
                number = start = 0
                for r in records(content):
                    ids = r.ids().astype("<u4")
                    ends = np.cumsum(r.lengths)
                    begins = ends - r.lengths
                    yield pd.DataFrame(
                        {
                            "file": file, "number": np.arange(number, number + len(ends)), "key": pd.array(r.keys, "Int64"),
                            "start_in_file": start + begins, "ids": [ids[a:b].tobytes() for a, b in zip(begins, ends)],
                        }
                    )
                    number, start = number + len(ends), start + r.n_ids

    return files.mapInPandas(decode, "file long, number long, key long, start_in_file long, ids binary")


def token_digests(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """One row per document of the files: ``key, start`` (ids before it in all files), ``n_tokens`` and ``ids_crc32``.

    Only one row per file is ordered in one task, to sum up the files before each.
    """
    back = read_token_files(spark, path)
    docs = measured(back.select("file", "key", "start_in_file", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")))
    sizes = docs.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = measured(sizes.select("file", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before")))
    out = docs.join(before, "file")
    own = ("start", "n_tokens", "ids_crc32")
    return out.select(F.col("key").alias(f"{key}_" if key.lower() in own else key), (F.col("before") + F.col("start_in_file")).alias("start"), "n_tokens", "ids_crc32")
