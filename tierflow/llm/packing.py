"""Best-fit packing of tokenized documents into sequences, in bulk-synchronous rounds.

Documents are tokenized, cut into pieces where they are longer than a sequence, and
range-sorted by length, longest first, which gives every piece its rank.  Pieces of one
length are interchangeable, and so are sequences with the same gap.  So the rounds work on
*runs*: so many pieces of one length from some rank on, so many sequences of one gap from
some number on.  There are at most as many lengths as a sequence has tokens, whatever the
corpus holds; only these run lengths reach the driver.

A round takes the next length and sweeps the gaps upward from its successor (the smallest
gap that holds it).  Each sequence takes one piece per sweep; where pieces outnumber the
sequences of a gap, the lower ranks get them and the rest go on to the next gap.  Then the
gaps are updated, and the sweep is repeated until nothing fits; what is left opens new
sequences, as many pieces in each as fit.  The resulting table of (rank range, sequence
range, offset) is applied to the pieces by rank on the executors.
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tierflow.llm.common import map_rows, stored, stretches, worker_state

#: Words whose ids a worker remembers, twice as many at most.  A word takes about 200 bytes.
REMEMBERED_WORDS = 600_000
#: Bytes of text split into words at once; a longer text by itself.
ENCODED_BYTES = 4_000_000
#: Words encoded in one call.
TOGETHER = 400
#: ASCII marks that can stand behind a word.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


class ChunkEncoder:
    """Token ids of texts, remembering those of words.

    For tokenizers that lower-case, drop white space, take runs of letters and runs of
    marks apart and end every word's last token with ``</w>``.  So the ids of a chunk
    between white space do not depend on its neighbours, and those of a word with marks
    behind it are the word's and the marks'.  Chunks are found, told apart and put together
    again by Arrow; only words that differ are looked up one by one.
    """

    def __init__(self, path: str, words: int | None = None):
        self.bound = words or REMEMBERED_WORDS
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.words: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    @classmethod
    def of(cls, path: str, words: int) -> ChunkEncoder:
        """One encoder per worker process, whose tasks have one core each."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        kept = worker_state()
        if (path, words) not in kept:
            kept[path, words] = cls(path, words)
        return kept[path, words]

    def known(self, words: list[bytes]) -> list[bytes]:
        """The ids of each of ``words``, which differ."""
        if len(self.words) > self.bound:
            # Words in use are taken over from the older half when they next occur.
            self.older, self.words = self.words, {}
        known, older, missing = self.words, self.older, []
        for word in words:
            if word not in known:
                if word in older:
                    known[word] = older[word]
                else:
                    missing.append(word)
        self._encode_words([w for w in missing if _only_letters(w)])
        self._encode_each([w for w in missing if w not in known])
        return [known[w] for w in words]

    def _encode_words(self, words: list[bytes]) -> None:
        """Words of letters only, many in a call, told apart by the ends of words."""
        groups = [words[i : i + TOGETHER] for i in range(0, len(words), TOGETHER)]
        encoded = self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups], add_special_tokens=False)
        for group, found in zip(groups, encoded):
            ids = np.array(found.ids, "<u4")
            ends = (np.flatnonzero(self.is_end[ids]) + 1) * 4
            if len(ends) != len(group):
                continue  # left to be encoded one by one
            data, at = ids.tobytes(), 0
            for word, end in zip(group, ends.tolist()):
                self.words[word] = data[at:end]
                at = end

    def _encode_each(self, parts: list[bytes]) -> None:
        encoded = self.tokenizer.encode_batch_fast([c.decode(errors="replace") for c in parts], add_special_tokens=False)
        for part, found in zip(parts, encoded):
            self.words[part] = np.array(found.ids, "<u4").tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        split = pc.ascii_split_whitespace(_strings(texts))
        chunks = split.values.dictionary_encode()
        words, marks = _words_and_marks(chunks.dictionary)
        parts = pa.concat_arrays([words, marks]).dictionary_encode()
        known = pa.array(self.known(_each(parts.dictionary)), pa.large_binary()).take(parts.indices)
        ids = pc.binary_join_element_wise(known[: len(words)], known[len(words) :], pa.scalar(b"", pa.large_binary()))
        ids = ids.take(chunks.indices)
        _, ends, data = ids.buffers()
        at = np.frombuffer(ends, np.int64)[split.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [bytes(data[low:high]) for low, high in zip(at, at[1:])]


def _strings(texts: list[bytes]) -> pa.StringArray:
    """Bytes as strings whatever they hold; the functions used on them take bytes beyond ASCII as they are."""
    column = pa.array(texts, pa.binary())
    return pa.StringArray.from_buffers(len(column), *column.buffers()[1:])


def _each(column: pa.StringArray) -> list[bytes]:
    return column.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()


def _only_letters(word: bytes) -> bool:
    """Asked of the word as the tokenizer sees it, composed and lower-cased: both may turn a
    letter into one with a mark behind it, and marks go with what follows."""
    return word.isalpha() or not word.isascii() and unicodedata.normalize("NFC", word.decode(errors="replace")).lower().isalpha()


def _words_and_marks(chunks: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
    """Each chunk as a word and the marks behind it, where these are encoded apart; else whole, and no marks."""
    special = pc.match_substring(chunks, "<|")  # might be a special token
    whole = pc.if_else(special, chunks, pc.ascii_lower(chunks))  # A-Z only
    words = pc.ascii_rtrim(whole, characters=MARKS)
    behind = pc.subtract(pc.binary_length(whole), pc.binary_length(words)).to_numpy()
    at = np.flatnonzero((behind > 0) & ~special.to_numpy(zero_copy_only=False))
    marks = np.full(len(chunks), b"", object)
    split = np.zeros(len(chunks), bool)
    for k, word, chunk in zip(at.tolist(), *(_each(x.take(pa.array(at))) for x in (words, whole))):
        if _only_letters(word):
            split[k], marks[k] = True, chunk[len(word) :]
    return pc.if_else(pa.array(split), words, whole), _strings(marks.tolist())


def pieces(docs: DataFrame, tokenizer: str, size: int = 4096, end_id: int = 1, remembered: int | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of ``docs`` (doc_id, text): its ids and
    ``end_id``, cut every ``size`` ids."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = ChunkEncoder.of(tokenizer, remembered or REMEMBERED_WORDS)
        out = []
        doc_ids = batch.column(0).to_pylist()
        for low, texts in stretches(batch.column(1), ENCODED_BYTES):
            for doc_id, ids in zip(doc_ids[low : low + len(texts)], encoder.encode(texts)):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    out.append((doc_id, k, at // 4, len(part) // 4, zlib.crc32(part)))
        columns = list(zip(*out))
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return map_rows(docs.select("doc_id", "text"), run, "doc_id long, piece int, start long, length long, ids_crc32 long", keep=True)


def ranked(found: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """The pieces with their ``rank`` from 0, longest first, and (length, how many).

    Ranks come from the sorted order of range partitions and the counts of those before,
    so no length, however common, has to be in one task.
    """
    order = [F.col("length").desc(), F.xxhash64("doc_id", "piece"), "doc_id", "piece"]
    n = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = found.repartitionByRange(n, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    ordered = stored(
        ordered.withColumn("part", F.spark_partition_id()).withColumn("at", place.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    counts = ordered.groupBy("part", "length").count().collect()
    per_part, per_length = {}, {}
    for part, length, count in counts:
        per_part[part] = per_part.get(part, 0) + count
        per_length[length] = per_length.get(length, 0) + count
    before, total = [], 0
    for part in sorted(per_part):
        before.append((part, total))
        total += per_part[part]
    offsets = found.sparkSession.createDataFrame(before, "part int, before long")
    out = ordered.join(F.broadcast(offsets), "part")  # a row per shuffle partition
    return out.withColumn("rank", F.col("before") + F.col("at")).drop("part", "at", "before"), sorted(
        per_length.items(), reverse=True
    )


def best_fit(lengths: list[tuple[int, int]], size: int) -> list[tuple[int, int, int, int]]:
    """(first rank, how many, first sequence, offset) for runs of (length, count), longest first."""
    gaps: dict[int, list[tuple[int, int]]] = {}
    order: list[int] = []
    placed, rank, sequences = [], 0, 0

    def put(gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in gaps:
                insort(order, gap)
                gaps[gap] = []
            gaps[gap].append((first, count))

    for length, count in lengths:
        while count and (i := bisect_left(order, length)) < len(order):
            gap = order[i]
            first, have = gaps[gap].pop()
            take = min(have, count)
            placed.append((rank, take, first, size - gap))
            rank, count = rank + take, count - take
            if take < have:
                gaps[gap].append((first + take, have - take))
            if not gaps[gap]:
                del gaps[gap], order[i]
            put(gap - length, first, take)
        each = size // length
        for of_each, opened in ((each, count // each), (count % each, int(count % each > 0))):
            if opened:
                for k in range(of_each):
                    placed.append((rank, opened, sequences, k * length))
                    rank += opened
                put(size - of_each * length, sequences, opened)
                sequences += opened
    return placed


def pack(
    docs: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    size: int = 4096,
    end_id: int = 1,
    remembered: int | None = None,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): a row per piece.

    A null or empty text is the end id alone.  A null id stays null, repeated rows are
    packed each.  Other columns of ``docs`` are not carried.  An empty table gives no rows.
    ``remembered`` bounds the words a worker remembers: fewer take less memory and more time.
    """
    source = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows, lengths = ranked(stored(pieces(source, tokenizer, size, end_id, remembered)))
    first, _, sequence, offset = (
        np.array(c, np.int64) for c in (zip(*best_fit(lengths, size)) if lengths else ([], [], [], []))
    )

    def place(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rank = batch.column("rank").to_numpy(zero_copy_only=False)
        run = np.searchsorted(first, rank, "right") - 1
        columns = [batch.column(c) for c in batch.schema.names if c != "rank"]
        columns += [pa.array(sequence[run] + rank - first[run]), pa.array(offset[run])]
        yield pa.record_batch(columns, out.names)

    slim = rows.drop("rank").schema
    out = T.StructType([*slim, *T.StructType.fromDDL("sequence_id long, offset long")])
    return map_rows(rows, place, out)
