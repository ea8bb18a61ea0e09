"""Best-fit packing of tokenised documents into sequences.

Tokenising.  A text's ids end with one separator.  A text longer than a sequence
is cut into full sequences, the shorter remainder first.  Tasks cut the bytes of many
texts into words (with the blanks before them), which the tokenizer treats
independently, number the distinct ones with Arrow and gather the ids of each; ids
of words are remembered.  Texts with any other white space, a control character or
one of the tokenizer's added tokens are encoded as a whole.  Both give the ids of
encoding the whole text.

Packing (hierarchical residual packing).  Pieces are dealt to partitions by hash.
Each partition packs its pieces best-fit, longest first, and emits the bins that
are full or cannot gain from what is left; the rest become items of the next
round, where ``FAN_IN`` partitions merge into one, until one is left.

What is carried is bounded without losing anything: best fit leaves at most one
bin up to half full per partition (two would have been joined), and only such small
bins can still be placed into others.  A round that merges ``FAN_IN`` partitions
holds at most ``FAN_IN`` small bins, so of the bins of any one length no more than
``FAN_IN`` can ever receive one; the surplus is final.  A task therefore gets at
most ``FAN_IN * (1 + FAN_IN * width / 2)`` items, whatever the size of the input.

Every round is written to the shared folder; partitions sort their items, so a
task that runs again after a lost executor packs alike.

Defined results: a null text is empty (its one piece is the separator); equal rows
are packed each; an empty table gives an empty table.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import gc
import os
import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmarts.llm.common import stored

WIDTH = 1024
SEPARATOR = 2
FAN_IN = 8
ITEMS_PER_TASK = 200_000
#: Words that a worker remembers in two generations, and the longest of them: a word and
#: its ids take 250 bytes at most, so 170 MB, and workers live as long as their executor (a
#: line of a script without blanks is one word; it is encoded each time).
CACHED_WORDS, CACHED_LENGTH = 680_000, 32

#: Bytes of texts that are encoded together (one longer text is on its own): each of their
#: words is looked up once, however often it occurs.
CHUNK_BYTES = 4 << 20

# one pre-token: the merges apply to it directly
_PLAIN = re.compile(r" ?[A-Za-zÀ-ÖØ-öø-ÿ]+")
# any white space but blank and line end, and control or format characters
_ODD = (r"[\x00-\x09\x0b-\x1f\x7f-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}"
        r"\x{205f}-\x{2064}\x{3000}\x{feff}]")
_BLANK_BYTE, _LINE_END, _LETTER, _STOP = 1, 2, 4, 8


def _byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[33:127] = _STOP  # all that is no letter
    kinds[[*range(65, 91), *range(97, 123)]] = _LETTER
    kinds[32], kinds[10] = _BLANK_BYTE, _BLANK_BYTE | _LINE_END
    return kinds


_KINDS = _byte_kinds()


def word_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where words start in the bytes of texts that lie one after the other.

    Cut are places where the tokenizer always cuts, whatever stands around them: before a run
    of blanks and line ends, around the last line end before a word, and between a letter and
    an ASCII character that is none.
    """
    n = len(data)
    kinds = _KINDS[data]
    blank = (kinds & _BLANK_BYTE) != 0
    start = np.zeros(n, bool)
    if n:
        letter = (kinds & _LETTER) != 0
        letter[1:] |= (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # À to ÿ
        start[1:] = (blank[1:] & ~blank[:-1]) | (letter[:-1] & ((kinds[1:] & _STOP) != 0))
        alone = ((kinds[:-1] & _LINE_END) != 0) & ~blank[1:]
        inner = bounds[1:-1]
        alone[inner[(inner > 0) & (inner < n)] - 1] = False  # no word follows in its text
        start[:-1] |= alone
        start[1:] |= alone
        start[bounds[:-1][bounds[:-1] < n]] = True
    return np.flatnonzero(start)


def _byte_letters() -> dict[int, int]:
    """The letter that a byte-level vocabulary writes for each byte: printable ones stay."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + k for k, b in enumerate(hidden)}


_LETTERS = _byte_letters()
_BLANK = chr(_LETTERS[32])


class _Words(dict[str, bytes]):
    """Ids of words, in two generations: a word that is missing is looked for in the older one,
    else encoded, so words in use are kept and no word is held twice."""

    def __init__(self, merge: Callable, encode: Callable[[str], bytes]):
        super().__init__()
        self.merge, self.encode = merge, encode
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.pop(word, None)
        if ids is None:
            if not _PLAIN.fullmatch(word):
                ids = self.encode(word)
            else:
                if word.isascii():  # such letters stand for themselves
                    shown = _BLANK + word[1:] if word[0] == " " else word
                else:
                    shown = word.encode().decode("latin-1").translate(_LETTERS)
                tokens = [t.id for t in self.merge(shown)]
                ids = struct.pack(f"<{len(tokens)}I", *tokens)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED_WORDS // 2:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


def _bounds(column: pa.LargeStringArray | pa.LargeBinaryArray) -> np.ndarray:
    """Where each value starts among the bytes, and where the last ends."""
    if not len(column):
        return np.zeros(1, np.int64)
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes, remembering words."""

    _loaded: dict[str, Encoder] = {}

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        gc.set_threshold(100_000, 50, 50)  # many small objects, no cycles among them
        self.known = _Words(self.tokenizer.model.tokenize, self._encode)
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = "|".join([_ODD, *added])  # texts with these are encoded as a whole

    @classmethod
    def load(cls, path: str) -> Encoder:
        """One encoder per Python worker."""
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids for _, chunk in self.chunks(pa.array(texts, pa.string())) for ids in chunk]

    def chunks(self, texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
        """(first row, ids of each text) for runs of about ``CHUNK_BYTES``; null reads as empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds, row = _bounds(texts), 0
        while row < len(texts):
            stop = int(np.searchsorted(bounds, bounds[row] + CHUNK_BYTES, "right")) - 1
            stop = min(max(stop, row + 1), len(texts))
            chunk = texts.slice(row, stop - row)
            whole = pc.match_substring_regex(chunk, self.whole).to_numpy(zero_copy_only=False)
            if whole.any():
                rest = iter(self._by_words(chunk.filter(pa.array(~whole))))
                yield row, [self._encode(t.as_py()) if w else next(rest) for t, w in zip(chunk, whole)]
            else:
                yield row, self._by_words(chunk)
            row = stop

    def _by_words(self, texts: pa.LargeStringArray) -> list[bytes]:
        """Ids of texts from those of their distinct words."""
        bounds = _bounds(texts)
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        data = texts.buffers()[2].slice(bounds[0], bounds[-1] - bounds[0])
        bounds = bounds - bounds[0]
        starts = word_starts(np.frombuffer(data, np.uint8), bounds)
        words = pa.LargeStringArray.from_buffers(
            len(starts), pa.py_buffer(np.append(starts, bounds[-1])), data).dictionary_encode()
        known = list(map(self.known.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)))
        ids = pa.array(known, pa.large_binary()).take(words.indices)
        at = _bounds(ids)[np.searchsorted(starts, bounds)].tolist()
        ids = memoryview(ids.buffers()[2])
        return [bytes(ids[a:b]) for a, b in zip(at, at[1:])]


def cut(ids: bytes, width: int = WIDTH) -> list[tuple[int, bytes]]:
    """(start, ids) of each piece: the remainder first, then full sequences."""
    n = len(ids) // 4
    first = n if n <= width else n % width or width
    starts = [0, *range(first, n, width)]
    return [(s, ids[4 * s:4 * (first if s == 0 else s + width)]) for s in starts]


def pieces(docs: DataFrame, tokenizer_path: str, width: int = WIDTH, separator: int = SEPARATOR,
           keep_ids: bool = False, id_col: str = "doc_id") -> DataFrame:
    """``id_col, piece, start, length, ids_crc32`` (and ``ids``) of every row's pieces."""
    id_type = docs.schema[id_col].dataType.simpleString()
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.load(tokenizer_path)
        for batch in batches:
            for at, encoded in encoder.chunks(batch.column(1)):
                owner, piece, start, length, crc, kept = [], [], [], [], [], []
                for row, ids in enumerate(encoded, at):
                    for k, (s, part) in enumerate(cut(ids + end, width)):
                        owner.append(row)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        kept.append(part)
                out = [batch.column(0).take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()),
                       pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                       pa.array(crc, pa.int64())]
                names = [id_col, "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    out.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in kept],
                                        pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(out, names=names)

    schema = (f"`{id_col}` {id_type}, piece int, start long, length long, ids_crc32 long"
              + (", ids array<int>" if keep_ids else ""))
    return docs.select(id_col, "text").mapInArrow(run, schema)


def best_fit(lengths: np.ndarray, width: int = WIDTH) -> list[list[int]]:
    """Bins of indices into ``lengths`` (descending): each goes where it fits tightest."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms: list[int] = []  # rooms that some open bin has, ascending
    for i, n in enumerate(lengths.tolist()):
        at = bisect_left(rooms, n)
        if at == len(rooms):
            b, room = len(bins), width
            bins.append([])
        else:
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                del by_room[room], rooms[at]
        bins[b].append(i)
        room -= n
        if room:
            if room not in by_room:
                by_room[room] = []
                insort(rooms, room)
            by_room[room].append(b)
    return bins


_BIN = "length long, members array<long>, placed boolean, part int, seq long"


def _pack_round(items: DataFrame, parts: int, level: int, last: bool, width: int) -> DataFrame:
    """Pack ``items(length, members, part)`` within each of ``parts`` partitions.

    Returns bins: ``placed`` ones are final, the others are carried.
    """
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [f for f in frames if len(f)]
        if not rows:
            return
        pdf = pd.concat(rows, ignore_index=True)
        for part, own in pdf.groupby("part", sort=True):
            lengths = own["length"].to_numpy()
            key = np.array([m[0] for m in own["members"]])
            order = np.lexsort((key, -lengths))
            lengths, members = lengths[order], own["members"].to_numpy()[order]
            carried: dict[int, int] = {}
            out = []
            for k, b in enumerate(best_fit(lengths, width)):
                fill = int(lengths[b].sum())
                keep = False
                if not last and fill < width:
                    carried[fill] = carried.get(fill, 0) + 1
                    keep = carried[fill] <= FAN_IN
                own_members = np.concatenate([members[i] for i in b])
                if not keep:  # lengths become offsets
                    own_members[1::2] = np.cumsum(own_members[1::2]) - own_members[1::2]
                out.append((fill, own_members, not keep, int(part),
                            (level << 56) + (int(part) << 32) + k))
            yield pd.DataFrame(out, columns=["length", "members", "placed", "part", "seq"])

    return items.repartition(parts, F.col("part")).mapInPandas(pack, _BIN)


def pack(lengths: DataFrame, key: str = "key", width: int = WIDTH,
         items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """``key, sequence_id, offset`` for every row of ``lengths(key long unique, length)``."""
    total = lengths.count()
    parts = max(1, -(-total // items_per_task))
    level = 0
    items = lengths.where(F.col("length") < width).select(
        F.col("length").cast("long").alias("length"),
        F.array(F.col(key), F.col("length").cast("long")).alias("members"),
        F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("part"))
    done = None
    while True:
        bins = stored(_pack_round(items, parts, level, parts == 1, width), "packed-bins")
        final = bins.where("placed").select("seq", "members")
        done = final if done is None else done.unionByName(final)
        if parts == 1:
            break
        parts = -(-parts // FAN_IN)
        level += 1
        items = bins.where(~F.col("placed")).select(
            "length", "members", F.pmod(F.col("part"), F.lit(parts)).cast("int").alias("part"))
    # members of a placed bin list key, offset, key, offset, ...
    members = F.col("members")
    placed = (done.select("seq", F.explode(F.transform(
        F.sequence(F.lit(0), (F.size(members) / 2).cast("int") - 1),
        lambda i: F.struct(F.get(members, i * 2).alias("key"),
                           F.get(members, i * 2 + 1).alias("offset")))).alias("m"))
        .select(F.col("m.key").alias(key), F.col("seq").alias("sequence_id"), "m.offset"))
    full = lengths.where(F.col("length") >= width).select(
        key, (-F.col(key) - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(placed)


def pack_documents(docs: DataFrame, tokenizer_path: str, width: int = WIDTH,
                   separator: int = SEPARATOR, items_per_task: int = ITEMS_PER_TASK) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    cut_up = stored(pieces(docs, tokenizer_path, width, separator)
                    .withColumn("key", F.monotonically_increasing_id()), "pieces")
    # the written table fixes the keys
    placed = pack(cut_up.select("key", "length"), "key", width, items_per_task)
    return cut_up.join(placed, "key").drop("key")
