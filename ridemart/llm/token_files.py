"""Token-id files of independent zstandard frames with a trailing seek table.

Layout of a file, in the public seekable format of zstandard so that any zstandard tool can
inflate it:

* data frames: token ids as little-endian unsigned 32-bit integers, at most ``FRAME_IDS`` a
  frame, each frame independent of the others and with its own content checksum;
* a skippable frame with the document index: for each document its id, whether that is null,
  and where its ids start in the file;
* a skippable frame with the seek table: for each frame its compressed and inflated size and
  the low 32 bits of the XXH64 of its inflated bytes, then the number of frames and the magic.

A reader takes the last bytes, learns from them where frames start, and inflates only frames
that hold the documents it was asked for.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ridemart.llm.common import filesystem, new_file, stored
from ridemart.session import shared_folder

#: Ids of a frame (1 MiB inflated), and ids after which a file is closed at the next document.
FRAME_IDS = 1 << 18
FILE_IDS = 1 << 26
#: Documents after which a file is closed, however few ids they have: its index is held in memory.
FILE_DOCS = 1 << 20
END_ID = 1
#: Fixed values of the format: magics of skippable frames and of the seek table.
INDEX_MAGIC, SEEK_MAGIC, SEEKABLE_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
WITH_CHECKSUMS = 0x80

#: Words a worker remembers (about 100 MB), and the characters in them for each of these words.
REMEMBERED, LONG = 600_000, 32
#: Words encoded in one call, and bytes of texts whose words are looked up together.
TOGETHER, CHARACTERS = 1_000, 1 << 22


class CorruptFile(ValueError):
    """A token file is not laid out as its seek table says, or a checksum is wrong."""


# ---- tokens ----------------------------------------------------------------------------

#: Marks that are split from the end of a word; a letter or digit before them ends a piece anyway.
MARKS = ".,!?;:*#$%&"
#: Alternatives of a split that keep a run of letters in one piece, besides those that begin with a quote.
CLASSES = {r"[\p{L}]+", r"[\p{N}]", r"[\p{N}]+", r"[^\s\p{L}\p{N}]+"}
#: Letters below this one are composed already, and lower-casing them does not depend on their neighbours.
LATIN = "\u0250"


def _latin(word: str) -> bool:
    """Whether all letters are Latin ones; not the dotted capital I, whose dot lower-casing sets free."""
    return word.isascii() or max(word) < LATIN and "\u0130" not in word


class Encoder:
    """Ids of whole texts by a tokenizer that drops white space, with words remembered.

    For a tokenizer whose pre-tokenizer never joins characters across a space, the ids of a text
    are those of its words one after another. So the words of many texts are made distinct by
    Arrow, each distinct word that is not remembered is encoded once, and the ids of the texts are
    gathered from theirs. Words are learnt without the marks at their end, and Latin ones in lower
    case if the tokenizer lowers. ``safe`` says whether the tokenizer's file describes such a
    tokenizer; if not, whole texts are encoded.

    Words are remembered in two generations: when the younger is full it becomes the older one, and
    only words that are met again are carried over, without being encoded anew.
    """

    def __init__(self, path: str):
        import json
        import os

        import numpy as np

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        steps = str(made.get("pre_tokenizer")), str(made.get("normalizer"))
        self.lowers = "'Lowercase'" in steps[1]
        # Pieces are letters, single digits or marks, and white space is in none of them.
        self.safe = "[^\\\\s\\\\p{L}\\\\p{N}]+" in steps[0] and "'invert': True" in steps[0] and "add_prefix_space': False" in steps[0]
        self.marks = {t["content"] for t in made.get("added_tokens", [])}
        self.safe = self.safe and all("<" in t and not re.search(r"\s", t) for t in self.marks)
        self.letters = self._letters_only(made) if self.safe else None
        model = made["model"]
        #: Whether an id ends a piece, by the suffix of such ids.
        self.ends = np.zeros(max([*model.get("vocab", {}).values(), -1]) + 1 if self.letters else 0, bool)
        if self.letters:
            self.ends[[i for t, i in model["vocab"].items() if t.endswith(model["end_of_word_suffix"])]] = True
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.characters = 0

    def _letters_only(self, made: dict):
        """The same tokenizer for words of lower-case Latin letters, which no step before the model changes or splits; or none."""
        from tokenizers import Tokenizer, pre_tokenizers

        normalizer, split, model = made["normalizer"] or {}, made["pre_tokenizer"], made["model"]
        changes = normalizer.get("normalizers", [normalizer] if normalizer else [])
        spaces = [c for c in changes if c["type"] == "Replace" and c["pattern"] == {"Regex": r"\s+"} and c["content"] == " "]
        steps = split.get("pretokenizers", [])
        if (
            any(c["type"] not in ("NFC", "Lowercase") for c in changes if c not in spaces)
            or [t["type"] for t in steps] != ["Split", "ByteLevel"]
            or steps[1]["use_regex"]
            or any(a[:1] != "'" and a not in CLASSES for a in steps[0]["pattern"].get("Regex", "?").split("|"))
            or r"[\p{L}]+" not in steps[0]["pattern"]["Regex"].split("|")
            or model["type"] != "BPE"
            or model.get("dropout")
            or not model.get("end_of_word_suffix")
        ):
            return None
        plain = Tokenizer.from_str(self.tokenizer.to_str())
        plain.normalizer = None
        plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        return plain

    def _whole(self, texts: list[str]) -> list[bytes]:
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in encoded]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Words of lower-case Latin letters, encoded as one text, whose ids are parted where a piece ends."""
        import numpy as np

        found = self.letters.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids
        ids = np.array(found, np.uint32)
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(words) or ends[-1] != 4 * len(ids):
            return self._whole(words)
        packed = ids.tobytes()
        return [packed[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _learn(self, unknown: list[str]) -> None:
        """Adds the words to the young generation, and the heads and tails they were made of."""
        known, lowers, letters = self.young, self.lowers, self.letters is not None
        parts, plain, others = [], set(), set()
        for word in unknown:
            head = word
            if not word.isalpha():
                if "<" in word:  # which may begin a special token
                    others.add(word)
                    continue
                # Normalising may turn a letter that is not Latin into one with a combining mark,
                # which would make one piece with the marks after it.
                bare = word.rstrip(MARKS)
                last = bare[-1:]
                if last.isalnum() and (last.isascii() or letters and last.isalpha() and _latin(last)):
                    head = bare
            tail = word[len(head) :]
            latin = head.isascii() or letters and _latin(head)
            if latin and lowers:
                head = head.lower()
            if head not in known:
                (plain if latin and letters and head.isalpha() else others).add(head)
            if tail and tail not in known:
                others.add(tail)
            if tail or head != word:
                parts.append((word, head, tail))
        new, rest = list(plain), list(others)
        for at in range(0, len(new), TOGETHER):
            some = new[at : at + TOGETHER]
            known.update(zip(some, self._letters(some), strict=True))
        known.update(zip(rest, self._whole(rest), strict=True))
        for word, head, tail in parts:
            known[word] = known[head] + known[tail] if tail else known[head]
        self.characters += sum(map(len, new)) + sum(map(len, rest)) + sum(len(word) for word, _, _ in parts)

    def _ids(self, words: list[str]) -> list[bytes]:
        """The ids of each of some distinct words."""
        known, older = self.young, self.old
        found = list(map(known.get, words))
        missing = [k for k, ids in enumerate(found) if ids is None]
        new = []
        for k in missing:
            word = words[k]
            ids = older.get(word)
            if ids is None:
                new.append(word)
            else:
                known[word] = ids
                self.characters += len(word)
        self._learn(new)
        for k in missing:
            found[k] = known[words[k]]
        if 2 * len(known) > REMEMBERED or 2 * self.characters > LONG * REMEMBERED:
            self.old, self.young, self.characters = known, {}, 0
        return found

    def encode(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text as native unsigned 32-bit integers."""
        import pyarrow as pa

        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= CHARACTERS:
                yield from self.encode_column(pa.array(held, pa.large_string()))
                held, size = [], 0
        yield from self.encode_column(pa.array(held, pa.large_string()))

    def encode_column(self, texts) -> Iterator[bytes]:
        """The same for an Arrow array of strings without nulls; some texts at a time."""
        import numpy as np
        import pyarrow.compute as pc

        past = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(texts):
            done = int(past[at - 1]) if at else 0
            stop = min(len(texts), int(np.searchsorted(past, done + CHARACTERS)) + 1)
            yield from self._some(texts.slice(at, stop - at))
            at = stop

    def _some(self, texts) -> Iterator[bytes]:
        import numpy as np
        import pyarrow.compute as pc

        if not self.safe:
            yield from self._whole(texts.to_pylist())
            return
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        found = self._ids(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts, ids = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(found), np.uint32)
        words = coded.indices.to_numpy()
        # Where each word's ids lie among those of all words, and in the text.
        counts = sizes[words]
        past = np.concatenate(([0], np.cumsum(counts)))
        gathered = ids[np.repeat(starts[words] - past[:-1], counts) + np.arange(past[-1])].tobytes()
        lists = np.concatenate(([0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))))
        edges = (4 * past[lists]).tolist()
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            yield gathered[a:b]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for all tasks of a worker."""
    return Encoder(path)


# ---- one file --------------------------------------------------------------------------


class Writer:
    """Writes documents' ids in order; ``close`` adds the index and the seek table."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = 3):
        import numpy as np
        import zstandard

        self.np, self.out, self.frame_ids = np, out, frame_ids
        self.compress = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress
        self.held: list = []
        self.held_ids = self.ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids) -> None:
        self.docs.append((doc_id or 0, doc_id is None, self.ids))
        rest = self.np.asarray(ids, "<u4")
        self.ids += len(rest)
        while len(rest):
            room = self.frame_ids - self.held_ids
            self.held.append(rest[:room])
            self.held_ids += len(rest[:room])
            rest = rest[room:]
            if self.held_ids == self.frame_ids:
                self._flush()

    def _flush(self) -> None:
        from xxhash import xxh64_intdigest

        data = self.np.concatenate(self.held).tobytes()
        frame = self.compress(data)
        self.out.write(frame)
        self.frames.append((len(frame), len(data), xxh64_intdigest(data) & 0xFFFFFFFF))
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        if self.held_ids:
            self._flush()
        np = self.np
        docs = np.array(self.docs or np.zeros((0, 3)), "<i8").tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(docs)) + docs)
        self.frames.append((8 + len(docs), 0, 0))
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()


class Reader:
    """Random access to a file; ``source`` needs size(), seek() and read()."""

    def __init__(self, source):
        import numpy as np

        self.np, self.source = np, source
        end = source.size()
        if end < 17:
            raise CorruptFile("too short for a seek table")
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != WITH_CHECKSUMS:
            raise CorruptFile("no seek table at the end")
        size = 12 * frames + 9
        if end < size + 8 or struct.unpack("<II", self._at(end - size - 8, 8)) != (SEEK_MAGIC, size):
            raise CorruptFile("the seek table is not framed as it says")
        table = np.frombuffer(self._at(end - size, size - 9), "<u4").reshape(-1, 3).astype(np.int64)
        self.frames = table[:-1]
        self.begins = np.concatenate(([0], np.cumsum(table[:, 0])))  # of frames, in the file
        self.starts = np.concatenate(([0], np.cumsum(self.frames[:, 1]))) // 4  # of frames, in ids
        if self.begins[-1] != end - size - 8:
            raise CorruptFile("the frames do not fill the file")
        index = self._at(int(self.begins[-2]), int(table[-1, 0]))
        if struct.unpack("<II", index[:8]) != (INDEX_MAGIC, len(index) - 8):
            raise CorruptFile("no document index before the seek table")
        #: Columns: id, whether it is null, first id's place.
        self.docs = np.frombuffer(index[8:], "<i8").reshape(-1, 3)
        self.ids = int(self.starts[-1])
        self._last: tuple[int, bytes] = (-1, b"")
        #: Frames inflated so far.
        self.inflated = 0

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(place)
        got = self.source.read(size)
        if len(got) != size:
            raise CorruptFile("the file is shorter than it says")
        return got

    def frame(self, k: int) -> bytes:
        """The inflated bytes of a frame, checked; the last one asked for is kept."""
        import zstandard
        from xxhash import xxh64_intdigest

        if self._last[0] != k:
            packed, size, checksum = (int(x) for x in self.frames[k])
            try:
                data = zstandard.ZstdDecompressor().decompress(self._at(int(self.begins[k]), packed), max_output_size=size)
            except zstandard.ZstdError as e:
                raise CorruptFile(f"frame {k} cannot be inflated: {e}") from e
            if len(data) != size or xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
                raise CorruptFile(f"frame {k} does not match its checksum")
            self._last = k, data
            self.inflated += 1
        return self._last[1]

    def span(self, position: int) -> tuple[int, int]:
        """Where the ids of the position-th document start and end in the file."""
        end = int(self.docs[position + 1, 2]) if position + 1 < len(self.docs) else self.ids
        return int(self.docs[position, 2]), end

    def pieces(self, position: int) -> Iterator[bytes]:
        """The ids of a document as bytes, frame by frame."""
        start, end = self.span(position)
        k = bisect.bisect_right(self.starts, start) - 1
        while start < end:
            first, stop = int(self.starts[k]), min(end, int(self.starts[k + 1]))
            yield self.frame(k)[4 * (start - first) : 4 * (stop - first)]
            start, k = stop, k + 1

    def document(self, position: int):
        """The ids of a document; inflates only frames that hold some of them."""
        return self.np.frombuffer(b"".join(self.pieces(position)), "<u4")

    def positions(self, doc_id: int | None) -> list[int]:
        same = (self.docs[:, 1] == 1) if doc_id is None else (self.docs[:, 0] == doc_id) & (self.docs[:, 1] == 0)
        return self.np.nonzero(same)[0].tolist()


# ---- whole tables ----------------------------------------------------------------------


def write(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    partitions: int | None = None,
    file_ids: int = FILE_IDS,
    file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Writes the ids of all documents in ascending order of the key (nulls last).

    Returns the stored list of files: path, part and place in order, docs, ids, and ``start``,
    the ids of all files before. Texts are shuffled once, by ranges of the key; rows with equal
    keys are told apart by a hash of the text and then interchangeable. A null or empty text has
    the end id only; an empty table has no file. Other columns are not read.
    """
    import pyarrow as pa

    tied = F.xxhash64(text)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(text, F.lit("")).alias("text"), tied.alias("tied"))
    order = [F.asc_nulls_last("key"), F.asc("tied")]
    ranged = rows.repartitionByRange(partitions, *order) if partitions else rows.repartitionByRange(*order)
    sorted_rows = ranged.sortWithinPartitions(*order)
    contents = pa.schema(
        [("path", pa.string()), ("part", pa.int64()), ("place", pa.int64()), ("docs", pa.int64()), ("ids", pa.int64())]
    )

    def files(batches):
        import numpy as np
        from pyspark import TaskContext

        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        encode = encoder(tokenizer).encode_column
        part, closed, out, path = TaskContext.get().partitionId(), [], None, ""
        end = np.uint32(END_ID).tobytes()

        def close():
            out.close()
            closed.append({"path": path, "part": part, "place": len(closed), "docs": len(out.docs), "ids": out.ids})

        for batch in batches:
            for key, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                if out is None:
                    path = new_file(root, ".ids.zst")
                    out = Writer(store.open_output_stream(path, compression=None))
                out.add(key, np.frombuffer(ids + end, np.uint32))
                if out.ids >= file_ids or len(out.docs) >= file_docs:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist(closed, schema=contents)

    listed = sorted_rows.mapInArrow(files, "path string, part long, place long, docs long, ids long")
    before = W.orderBy("part", "place").rowsBetween(W.unboundedPreceding, -1)  # one row a file
    made = stored(listed, "token_files")
    return made.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read(files: DataFrame, folder: str) -> DataFrame:
    """One row for each document from the files: key, start, n_tokens, ids_crc32, path, position."""
    import pyarrow as pa

    shape = pa.schema(
        [("key", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
         ("path", pa.string()), ("position", pa.int64())]
    )

    def documents(batches):
        store, _ = filesystem(folder)
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as source:
                    reader, rows = Reader(source), []
                    for position in range(len(reader.docs)):
                        start, end = reader.span(position)
                        crc = 0
                        for piece in reader.pieces(position):
                            crc = zlib.crc32(piece, crc)
                        doc, null, _ = reader.docs[position]
                        rows.append((None if null else int(doc), first + start, end - start, crc, path, position))
                        if len(rows) == 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)

    listed = files.select("path", "start").repartition(max(1, files.count()), "path")
    return listed.mapInArrow(documents, "key long, start long, n_tokens long, ids_crc32 long, path string, position long")


def tokenizer_path() -> str:
    """The registered tokenizer's file; elsewhere the path is a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(spark: SparkSession, folder: str) -> DataFrame:
    """op7: all documents written as token files and read back."""
    target = shared_folder(spark, "op7_tokens")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    found = read(write(docs, target, tokenizer_path()), target)
    return found.select(F.col("key").alias("doc_id"), "start", "n_tokens", "ids_crc32")
