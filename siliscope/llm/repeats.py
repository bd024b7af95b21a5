"""Removal of repeated passages with a run-length index (run-compressed Burrows-Wheeler transform, sampled run ends).

Texts are UTF-8 bytes. A byte goes if it is covered by a string of ``LENGTH`` bytes that also starts earlier: in a document
with a smaller id, or earlier in the same one. Strings are judged on the input.

No index could hold the whole corpus, so equal strings are first brought together.

1. Every window of LENGTH bytes is named by the smallest hash of its ``SEED``-byte substrings. Neighbouring windows with
   the same such substring make a fragment (at most ``MOST`` windows, all different); equal windows have equal names. Fragments travel as hashes and
   places, packed, one row per task and range of names.
2. A name with a single fragment is settled. Of fragments that are equal as a whole only the first goes on, the others
   are marked. What is left are different fragments of one name: the borders and variants of repeated passages.
3. The bytes of these fragments are cut out of the texts and grouped by name into blocks. A block's fragments are sorted
   into a Burrows-Wheeler transform; its runs, with the text places at both ends of each run, are the index. From the
   samples alone the matching statistic of every place is streamed (one less per step until the next sample), with
   the neighbour it matches; places whose match reaches LENGTH form chains, of which all but the earliest are marked.
4. Names with more than ``BLOCK_FRAGMENTS`` different fragments (a short line common to very many documents) would not
   fit a block. Their windows are compared one by one through an aggregate with a combiner, which no hot name can clog.
5. Marks come back to their documents, which lose the marked bytes.

Names, fragments and windows are compared by 64-bit hashes besides the bytes in step 3; two different fragments of the
same name would have to collide in the second hash to be taken for equal (2^-64 per pair). A task settles repeats
among its own rows and sends each distinct fragment once; names that are hot within a task are dealt by fragment.

A NULL or empty text has no bytes. NULL ids come last and are one id. Rows that share an id share its place in the order:
equal strings at the same place of both are not earlier than each other, and each row is judged by its own text.
Further columns do not matter, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, stored, texts_for_python
from .textwords import BASE, PIECE, STEP, mix, slices, text_arrays

LENGTH = 100
SEED = 32
MOST = LENGTH - SEED + 1
HOT_IN_TASK = 256
BLOCK_FRAGMENTS = 4096
BLOCK_BYTES = 1 << 17
ENTRIES = 300_000
ROW_ENTRIES = 512
LAST_ID = (1 << 63) - 1

_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
_ENTRY = [("name", np.uint64), ("whole", np.uint64), ("doc", np.int64), ("start", np.uint32), ("windows", np.uint8)]


def _powers(n: int, of: np.uint64) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, of)]))


class Fragments:
    """Cuts texts into fragments; the tables of powers are kept between calls."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def _tables(self, n: int):
        if len(self.up) <= n:
            self.up, self.down = _powers(n, BASE), _powers(n, _INVERSE)
        return self.up, self.down

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """text, start, windows, name, whole of the fragments of several texts, in order."""
        parts = []
        if len(offsets) == 2:  # one text, perhaps long: pieces that overlap by a window less one byte
            for base in range(0, max(1, len(data) - LENGTH + 1), PIECE):
                piece = data[base : base + PIECE + LENGTH - 1]
                text, start, *rest = self._piece(piece, np.array([0, len(piece)]))
                parts.append((text, start + base, *rest))
        else:
            parts.append(self._piece(data, offsets))
        return [np.concatenate(column) for column in zip(*parts)]

    def _piece(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        if n < LENGTH:
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        up, down = self._tables(n)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        hashes = mix((sums[SEED:] - sums[:-SEED]) * down[: n - SEED + 1])
        least, width = hashes, 1
        while 2 * width <= MOST:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < MOST:
            least = np.minimum(least[: len(least) - (MOST - width)], least[MOST - width :])
        # Windows that would reach into the next text.
        crossing = np.zeros(n + 1, np.int32)
        ends = offsets[1:][offsets[1:] > offsets[:-1]]
        begins = offsets[:-1][offsets[1:] > offsets[:-1]]
        np.add.at(crossing, np.maximum(begins, ends - LENGTH + 1), 1)
        np.add.at(crossing, ends, -1)
        valid = np.cumsum(crossing)[: len(least)] == 0
        # A fragment also ends where the substring that names it falls out on the left, so its windows are all different.
        first = valid.copy()
        first[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (hashes[: len(least) - 1] == least[:-1])
        starts = np.flatnonzero(first)
        if not len(starts):
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        last = valid.copy()
        last[:-1] &= ~valid[1:] | first[1:]
        counts = np.flatnonzero(last) + 1 - starts
        whole = mix((sums[starts + counts + LENGTH - 1] - sums[starts]) * down[starts] + counts.astype(np.uint64) * STEP)
        text = np.searchsorted(offsets, starts, "right") - 1
        return text, starts - offsets[text], counts, least[starts], whole


def whole_hash(data: np.ndarray, starts: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The hash of given fragments of one text, 0 for those that do not lie in it."""
    lengths = windows.astype(np.int64) + LENGTH - 1
    inside = starts + lengths <= len(data)
    acc = np.zeros(len(starts), np.uint64)
    starts = np.where(inside, starts, 0)
    if inside.any():
        for step in range(int(lengths[inside].max()) - 1, -1, -1):
            on = np.flatnonzero(inside & (lengths > step))
            acc[on] = acc[on] * BASE + data[starts[on] + step].astype(np.uint64) + np.uint64(1)
    return np.where(inside, mix(acc + windows.astype(np.uint64) * STEP), np.uint64(0))


_FOUND = "part int, doc long, start long, windows int, whole long, name long, packed binary"


def _found_batch(marks: np.ndarray, open_: np.ndarray, parts=None, packed=None) -> pa.RecordBatch:
    """Marked fragments (name NULL), open fragments, and packed entries for a part."""
    both, extra = np.concatenate([marks, open_]), 0 if parts is None else len(parts)
    null = lambda kind, size: pa.nulls(size, kind)
    spread = (mix(both["doc"].astype(np.uint64) * STEP + both["start"]) % np.uint64(9973)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(spread), pa.array(parts if extra else [], pa.int32())]),
            pa.concat_arrays([pa.array(both["doc"]), null(pa.int64(), extra)]),
            pa.concat_arrays([pa.array(both["start"].astype(np.int64)), null(pa.int64(), extra)]),
            pa.concat_arrays([pa.array(both["windows"].astype(np.int32)), null(pa.int32(), extra)]),
            pa.concat_arrays([pa.array(both["whole"].view(np.int64)), null(pa.int64(), extra)]),
            pa.concat_arrays([null(pa.int64(), len(marks)), pa.array(open_["name"].view(np.int64)), null(pa.int64(), extra)]),
            pa.concat_arrays([null(pa.binary(), len(both)), pa.array(packed or [], pa.binary())]),
        ],
        ["part", "doc", "start", "windows", "whole", "name", "packed"],
    )


def _firsts(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by name and fragment, the earliest first; and which are the first of their fragment."""
    entries = entries[np.lexsort((entries["start"], entries["doc"], entries["whole"], entries["name"]))]
    new = np.ones(len(entries), bool)
    new[1:] = (entries["whole"][1:] != entries["whole"][:-1]) | (entries["name"][1:] != entries["name"][:-1])
    return entries, new


def _later(entries: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Entries that start later than the first of their fragment."""
    first = entries[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(entries) else entries
    return entries[(entries["doc"] != first["doc"]) | (entries["start"] != first["start"])]


def by_part(entries: np.ndarray, hot: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries and heralds by part, and the part of each: that of the name, or for hot names that of the fragment.

    A name is the least of many hashes, so most names are small numbers; it is mixed to fall on all parts alike.
    """
    heralds = entries[np.flatnonzero(hot)[np.unique(entries["name"][hot], return_index=True)[1]]]
    heralds["windows"] = 0  # tells the name's own part
    where = np.concatenate([np.where(hot, entries["name"] ^ entries["whole"], entries["name"]), heralds["name"]])
    entries, part = np.concatenate([entries, heralds]), (mix(where) >> np.uint64(32)).astype(np.int64) * parts >> 32
    order = np.lexsort((entries["start"], entries["doc"], part))
    return entries[order], part[order]


def _by_name(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sorted entries: the number of the name of each, and how many entries each name has."""
    change = np.ones(len(entries), bool)
    change[1:] = entries["name"][1:] != entries["name"][:-1]
    number = np.cumsum(change) - 1
    return number, np.bincount(number, minlength=0)


def _fragments(documents: DataFrame) -> DataFrame:
    """Marked fragments (name NULL) and open ones: those whose name has several different fragments."""
    partitions = shuffle_partitions(documents.sparkSession)
    parts = 4 * partitions
    length = np.dtype(_ENTRY).itemsize

    def cut(batches):
        fragments, held, rows = Fragments(), [], 0

        def packed(entries):
            entries, new = _firsts(entries)
            marks, entries = _later(entries, new), entries[new]
            number, counts = _by_name(entries)
            hot = counts[number] > HOT_IN_TASK
            entries["windows"][hot] |= 128  # dealt by fragment: its name is known to have several
            entries, part = by_part(entries, hot, parts)
            cuts = np.searchsorted(part, np.arange(parts + 1))
            full = np.flatnonzero(np.diff(cuts)).astype(np.int32)
            pieces = [(p, a, min(a + ROW_ENTRIES, cuts[p + 1])) for p in full for a in range(cuts[p], cuts[p + 1], ROW_ENTRIES)]
            blobs = [b"".join(entries[name][a:b].tobytes() for name, _ in _ENTRY) for _, a, b in pieces]
            return _found_batch(marks, entries[:0], np.array([p for p, _, _ in pieces], np.int32), blobs)

        for batch in slices(batches, 1):
            text, start, windows, name, whole = fragments(*text_arrays(batch.column(1)))
            entries = np.empty(len(text), _ENTRY)
            entries["doc"] = batch.column(0).to_numpy()[text]
            entries["start"], entries["windows"], entries["name"], entries["whole"] = start, windows, name, whole
            held.append(entries)
            rows += len(entries)
            if rows >= ENTRIES:
                yield packed(np.concatenate(held))
                held, rows = [], 0
        if rows:
            yield packed(np.concatenate(held))

    def unpacked(blob: bytes) -> np.ndarray:
        entries, at = np.empty(len(blob) // length, _ENTRY), 0
        for name, kind in _ENTRY:
            size = len(entries) * np.dtype(kind).itemsize
            entries[name] = np.frombuffer(blob[at : at + size], kind)
            at += size
        return entries

    def settle(batches):
        def settled(blobs):
            entries = np.concatenate([unpacked(blob) for blob in blobs])
            herald = entries["windows"] == 0
            told = np.unique(entries["name"][herald])
            entries, new = _firsts(entries[~herald])
            by_fragment = entries["windows"] >= 128
            entries["windows"] &= 127
            marks, by_fragment, entries = _later(entries, new), by_fragment[new], entries[new]
            number, counts = _by_name(entries)
            several = counts[number] > 1 if len(entries) else np.zeros(0, bool)
            return _found_batch(marks, entries[several | by_fragment | np.isin(entries["name"], told)])

        current, blobs = None, []
        for batch in batches:
            passing = batch.filter(pa.compute.is_null(batch.column("packed")))
            if passing.num_rows:
                yield passing
            packed = batch.filter(pa.compute.is_valid(batch.column("packed")))
            for part, blob in zip(packed.column("part").to_pylist(), packed.column("packed")):
                if part != current and blobs:
                    yield settled(blobs)
                    blobs = []
                current = part
                blobs.append(blob.as_py())
        if blobs:
            yield settled(blobs)

    dealt = texts_for_python(documents.select("doc", "text")).mapInArrow(cut, _FOUND).repartition(partitions, "part")
    return dealt.sortWithinPartitions("part").mapInArrow(settle, _FOUND).select("doc", "start", "windows", "whole", "name")


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform of several strings with the text places at both ends of every run.

    Strings end with marks of their own, so no match crosses from one into the next.
    """

    def __init__(self, strings: list[np.ndarray]):
        lengths = np.array([len(s) for s in strings])
        ends = np.cumsum(lengths + 1) - 1
        text = np.zeros(ends[-1] + 1, np.int64)
        text[ends] = np.arange(len(strings))
        inside = np.ones(len(text), bool)
        inside[ends] = False
        text[inside] = np.concatenate(strings).astype(np.int64) + len(strings)
        order = self._sorted_suffixes(text, ends, len(strings))
        last = text[order - 1]  # the transform; the text is read as a circle
        heads = np.flatnonzero(np.concatenate([[True], last[1:] != last[:-1]]))
        self.text, self.size = text, len(text)
        self.letters, self.run_starts = last[heads], heads
        # Sampled ends: where a run begins, and where the run before it ends.
        by_place = np.argsort(order[heads])
        self.begin = order[heads][by_place]
        self.before = np.where(heads > 0, order[heads - 1], -1)[by_place]
        self.match = self._common(self.begin, self.before)

    @staticmethod
    def _sorted_suffixes(text: np.ndarray, ends: np.ndarray, marks: int) -> np.ndarray:
        """The suffixes in order: first by six letters, then by doubling the length that the ranks stand for."""
        n, reach = len(text), 6
        to_end = np.repeat(ends, np.diff(np.concatenate([[-1], ends]))) - np.arange(n)
        letters = np.maximum(text - marks + 1, 0)
        padded = np.concatenate([letters, np.zeros(reach, np.int64)])
        key = np.zeros(n, np.int64)
        for step in range(reach):
            key = key * 257 + np.where(step <= to_end, padded[step : step + n], 0)
        # Six letters that hold an end mark differ from all others of the same letters by the mark.
        mark = np.where(to_end < reach, np.repeat(np.arange(len(ends)) + 1, np.diff(np.concatenate([[-1], ends]))), 0)
        order = np.lexsort((mark, key))
        change = (key[order][1:] != key[order][:-1]) | (mark[order][1:] != mark[order][:-1])
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(change)])
        while rank[order[-1]] != n - 1:
            follow = np.zeros(n, np.int64)
            follow[: max(0, n - reach)] = rank[reach:] + 1
            key = rank * np.int64(n + 1) + follow
            order = np.argsort(key)
            sorted_key = key[order]
            rank = np.empty(n, np.int64)
            rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            reach *= 2
        return order

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        length = np.zeros(len(a), np.int64)
        live = np.flatnonzero(b >= 0)
        while len(live):
            x, y = a[live] + length[live], b[live] + length[live]
            fits = np.maximum(x, y) < self.size
            live, x, y = live[fits], x[fits], y[fits]
            live = live[self.text[x] == self.text[y]]
            length[live] += 1
        return length

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For every place of the text how far its longest match in sorted order goes, and the place it matches.

        Between two samples both follow from the sample below: the neighbour moves on with the place, the match loses a byte.
        """
        places = np.arange(self.size)
        sample = np.searchsorted(self.begin, places, "right") - 1
        known = sample >= 0
        step = places - self.begin[sample]
        neighbour = self.before[sample] + step
        matched = np.where(known & (self.before[sample] >= 0), np.maximum(self.match[sample] - step, 0), 0)
        return matched, np.where(matched > 0, neighbour, -1)


def later_windows(strings: list[np.ndarray], docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """string and offset of every window of LENGTH bytes that also starts earlier; strings are given with their places."""
    index = RunLengthIndex(strings)
    matched, neighbour = index.matching_statistics()
    parent = np.arange(index.size)
    linked = np.flatnonzero(matched >= LENGTH)
    parent[linked] = neighbour[linked]
    while True:  # the end of each chain of equal windows
        above = parent[parent]
        if np.array_equal(above, parent):
            break
        parent = above
    in_chain = np.union1d(linked, neighbour[linked])
    bounds = np.concatenate([[0], np.cumsum([len(s) + 1 for s in strings])])
    string = np.searchsorted(bounds, in_chain, "right") - 1
    offset = in_chain - bounds[string]
    doc, start, chain = docs[string], starts[string] + offset, parent[in_chain]
    order = np.lexsort((start, doc, chain))
    new = np.ones(len(order), bool)
    new[1:] = chain[order][1:] != chain[order][:-1]
    first = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    late = (doc[order] != doc[first]) | (start[order] != start[first])
    late = np.sort(order[late])
    return string[late], offset[late]


_MARK = "doc long, start long, windows int, whole long"


def _marked_in_blocks(cut_out: DataFrame) -> DataFrame:
    """Marks among the fragments (name, doc, start, bytes) of each name, by run-length indexes over blocks of names."""

    def search(batches):
        def marks(block):
            strings = [np.frombuffer(row[3], np.uint8) for row in block]
            docs, starts = (np.array([row[i] for row in block], np.int64) for i in (1, 2))
            string, offset = later_windows(strings, docs, starts)
            new = np.ones(len(string), bool)
            new[1:] = (string[1:] != string[:-1]) | (offset[1:] != offset[:-1] + 1)
            at = np.flatnonzero(new)
            windows = np.diff(np.append(at, len(string))).astype(np.int32)
            bounds = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
            whole = whole_hash(np.concatenate(strings), bounds[string[at]] + offset[at], windows)
            columns = [docs[string[at]], starts[string[at]] + offset[at], windows, whole.view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["doc", "start", "windows", "whole"])

        block, size, name = [], 0, None
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                if row[0] != name and size >= BLOCK_BYTES:
                    yield marks(block)
                    block, size = [], 0
                name = row[0]
                block.append(row)
                size += len(row[3])
        if block:
            yield marks(block)

    partitions = shuffle_partitions(cut_out.sparkSession)
    return cut_out.repartition(partitions, "name").sortWithinPartitions("name").mapInArrow(search, _MARK)


def _marked_by_window(windows: DataFrame) -> DataFrame:
    """Marks among single windows (name, doc, start, whole): all but the earliest of each window."""
    firsts = windows.groupBy("name", "whole").agg(F.min(F.struct("doc", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
    joined = windows.join(firsts.filter("n > 1"), ["name", "whole"]).filter(F.struct("doc", "start") > F.col("first"))
    return joined.select("doc", "start", F.lit(1).alias("windows"), "whole")


class Wanted:
    """Fragments asked for of the texts of a batch: columns text (binary) and wanted (list of structs)."""

    def __init__(self, text: pa.Array, wanted: pa.Array):
        self.data, self.offsets = text_arrays(text)
        counts = pa.compute.fill_null(pa.compute.list_value_length(wanted), 0).to_numpy()
        fields = wanted.flatten()
        self.field = {name.name: fields.field(i).to_numpy(zero_copy_only=False) for i, name in enumerate(fields.type)}
        self.row = np.repeat(np.arange(len(counts)), counts)
        self.start, self.windows = self.field["start"], self.field["windows"].astype(np.int64)

    def own(self) -> np.ndarray:
        """Whether each fragment has the hash it is asked for by; else it belongs to another row of the same id."""
        found = whole_hash(self.data, self.offsets[self.row] + self.start, self.windows)
        inside = self.start + self.windows + LENGTH - 1 <= np.diff(self.offsets)[self.row]
        return inside & (found.view(np.int64) == self.field["whole"])


def _cut_out(documents: DataFrame, open_: DataFrame) -> DataFrame:
    """name, doc, start, bytes (NULL for single windows of hot names), whole of the open fragments."""
    names = ["name", "doc", "start", "bytes", "whole"]

    def cut(batches):
        for batch in slices(batches, 1):
            wanted = Wanted(batch.column(1), batch.column(2))
            doc = batch.column(0).to_numpy()[wanted.row]
            own, hot, name = wanted.own(), wanted.field["hot"].astype(bool), wanted.field["name"]
            at = np.flatnonzero(own & ~hot)
            begin = wanted.offsets[wanted.row[at]] + wanted.start[at]
            end = begin + wanted.windows[at] + LENGTH - 1
            view = memoryview(np.ascontiguousarray(wanted.data))
            cut_bytes = pa.array([bytes(view[a:b]) for a, b in zip(begin.tolist(), end.tolist())], pa.binary())
            columns = [name[at], doc[at], wanted.start[at], cut_bytes, wanted.field["whole"][at]]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)
            at = np.flatnonzero(own & hot)
            count = wanted.windows[at]
            nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at = np.repeat(at, count)
            start = wanted.start[at] + nth
            single = whole_hash(wanted.data, wanted.offsets[wanted.row[at]] + start, np.ones(len(at), np.int64))
            columns = [name[at], doc[at], start, pa.nulls(len(at), pa.binary()), single.view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], names)

    hot = open_.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK_FRAGMENTS).select("name", F.lit(True).alias("hot"))
    wanted = open_.join(hot, "name", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = wanted.groupBy("doc").agg(F.collect_list(F.struct("name", "start", "windows", "whole", "hot")).alias("wanted"))
    held = documents.select("doc", F.encode("text", "UTF-8").alias("bytes")).join(wanted, "doc")
    return held.select("doc", "bytes", "wanted").mapInArrow(cut, "name long, doc long, start long, bytes binary, whole long")


def repeat_marks(documents: DataFrame) -> DataFrame:
    """doc, start, windows, whole: runs of windows that also start earlier. documents has doc (never NULL) and text."""
    found = stored(_fragments(documents), "fragments")
    cut_out = stored(_cut_out(documents, found.filter("name IS NOT NULL")), "open-fragments")
    in_blocks = _marked_in_blocks(cut_out.filter("bytes IS NOT NULL").select("name", "doc", "start", "bytes"))
    single = _marked_by_window(cut_out.filter("bytes IS NULL").select("name", "doc", "start", "whole"))
    return found.filter("name IS NULL").select("doc", "start", "windows", "whole").union(in_blocks).union(single)


def _removed(text: pa.Array, marks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all texts, where each text begins, and which bytes the marks cover."""
    wanted = Wanted(text, marks)
    own = wanted.own()
    begin = (wanted.offsets[wanted.row] + wanted.start)[own]
    change = np.zeros(len(wanted.data) + 1, np.int32)
    np.add.at(change, begin, 1)
    np.add.at(change, begin + wanted.windows[own] + LENGTH - 1, -1)
    return wanted.data, wanted.offsets, np.cumsum(change)[:-1] > 0


def _keyed(documents: DataFrame) -> DataFrame:
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    return documents.select(doc.alias("doc"), F.coalesce("text", F.lit("")).alias("text"), "doc_id")


def _with_marks(documents: DataFrame) -> DataFrame:
    keyed = _keyed(documents)
    marks = repeat_marks(keyed).groupBy("doc").agg(F.collect_list(F.struct("start", "windows", "whole")).alias("marks"))
    return keyed.join(marks, "doc", "left")


def repeat_report(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""

    def judge(batches):
        for batch in slices(batches, 1):
            data, offsets, gone = _removed(batch.column(1), batch.column(2))
            rows = []
            for begin, end in zip(offsets[:-1], offsets[1:]):
                text, lost = data[begin:end], gone[begin:end]
                n = int(np.count_nonzero(lost))
                spans = int(lost[0]) + int(np.count_nonzero(lost[1:] & ~lost[:-1])) if n else 0
                kept = text[~lost] if n else text
                rows.append((len(text), n, spans, hashlib.sha256(kept.tobytes()).hexdigest()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            arrays = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    held = _with_marks(documents).select("doc_id", F.encode("text", "UTF-8").alias("bytes"), "marks")
    return held.mapInArrow(judge, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(documents: DataFrame) -> DataFrame:
    """doc_id and the remaining text; a character that lost a byte goes as a whole."""

    def strip(batches):
        for batch in slices(batches, 1):
            data, offsets, gone = _removed(batch.column(1), batch.column(2))
            texts = [data[a:b][~gone[a:b]].tobytes().decode("utf-8", "ignore") for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    held = _with_marks(documents).select("doc_id", F.encode("text", "UTF-8").alias("bytes"), "marks")
    return held.mapInArrow(strip, f"doc_id {kind}, text string")
