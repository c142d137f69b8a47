"""Exact duplicates by Patricia tries whose terminal nodes own the texts that end there."""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillspark.llm.words import giving_back, parts, plain_texts, slices

#: Bytes of one trie; beyond it subtrees are spilled until half of it is left.
TRIE_BYTES = 48 << 20
#: What a node takes beside its label: the objects of a node with an entry.
_NODE_BYTES = 600
#: Spilled rows that are held before they are written.
_HELD_BYTES = 4 << 20

ROW = "text_sha256 binary, length bigint, text binary, keep_id bigint, group_size bigint"


class _Node:
    __slots__ = ("label", "children", "entry")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, _Node | Spilled] = {}
        self.entry: list | None = None  # digest, id, rows


@dataclass(eq=False)
class Spilled:
    """What stands in a trie for a subtree that was spilled: its number, how many bytes all of its
    texts share from the start, and what had been spilled inside it before."""

    number: int
    shared: int
    inner: list[Spilled] = field(default_factory=list)


def _shared(label: bytes, text: bytes, at: int) -> int:
    """How many leading bytes of the label stand in the text at ``at``, by halving."""
    low, high = 0, min(len(label), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class PatriciaTrie:
    """Compressed radix trie of byte strings. The node where a string ends keeps the winning id
    (the smallest, or the largest with ``largest``; null only if there is no other) and the
    number of rows. ``skip`` leading bytes are known to be equal in all strings."""

    def __init__(self, largest: bool = False, skip: int = 0):
        self.root, self.largest, self.bytes = _Node(b""), largest, 0
        self.skip, self.prefix, self.cuts = skip, b"", 0

    def insert(self, text: bytes, digest: bytes, owner: int | None, rows: int = 1) -> Spilled | None:
        """Add a string, or tell which spilled subtree it belongs to."""
        node, at, end = self.root, self.skip, len(text)
        if self.skip and not self.prefix:
            self.prefix = text[: self.skip]
        while at < end:
            child = node.children.get(text[at])
            if child is None:
                child = node.children[text[at]] = _Node(text[at:])
                self.bytes += end - at + _NODE_BYTES
                node = child
                break
            if isinstance(child, Spilled):
                return child
            if not text.startswith(child.label, at):
                child = self._split(node, child, text, at)
            node, at = child, at + len(child.label)
        if node.entry is None:
            node.entry = [digest, owner, rows]
            return None
        kept = node.entry
        if owner is not None and (
            kept[1] is None or (owner > kept[1] if self.largest else owner < kept[1])
        ):
            kept[1] = owner
        kept[2] += rows
        return None

    def _split(self, parent: _Node, child: _Node, text: bytes, at: int) -> _Node:
        """Cut an edge where the text leaves it; the upper half is returned."""
        shared = _shared(child.label, text, at)
        upper = _Node(child.label[:shared])
        child.label = child.label[shared:]
        upper.children[child.label[0]] = child
        parent.children[upper.label[0]] = upper
        self.bytes += _NODE_BYTES
        return upper

    def entries(self) -> Iterator[tuple[bytes, list]]:
        yield from self._below(self.root, self.prefix)

    @staticmethod
    def _below(top: _Node, before: bytes) -> Iterator[tuple[bytes, list]]:
        """Strings and entries of a subtree, one after the other; ``before`` stands above it."""
        path, stack = bytearray(before), [(top, len(before))]
        while stack:
            node, depth = stack.pop()
            del path[depth:]
            path += node.label
            if node.entry is not None:
                yield bytes(path), node.entry
            below = len(path)
            stack.extend((c, below) for c in node.children.values() if isinstance(c, _Node))

    def _place_to_cut(self) -> tuple[_Node, bytes] | None:
        """The first node that branches, and the bytes up to its end; in a trie that is one path,
        the node half way down. None if there is nothing below the root's only child."""
        chain, ends, path = [], [], bytearray(self.prefix)
        node = self.root
        while True:
            path += node.label
            chain.append(node)
            ends.append(len(path))
            below = [c for c in node.children.values() if isinstance(c, _Node)]
            if len(below) > 1:
                return node, bytes(path)
            if not below:
                break
            node = below[0]
        middle = (len(chain) - 1) // 2
        return (chain[middle], bytes(path[: ends[middle]])) if len(chain) > 2 else None

    def cut(
        self, least: int
    ) -> Iterator[tuple[_Node, int, Spilled, Iterator[tuple[bytes, list]]]]:
        """Take subtrees out, the largest first, until ``least`` bytes are left or none can go.

        For each: the node above it, the first byte of its edge, what may stand for it there, and
        its strings with their entries, which must be read before going on.
        """
        while self.bytes > least and (found := self._place_to_cut()) is not None:
            node, path = found
            sizes = {k: self._size(c) for k, c in node.children.items() if isinstance(c, _Node)}
            for first in sorted(sizes, key=sizes.get, reverse=True):
                if self.bytes <= least:
                    return
                self.bytes -= sizes[first]
                self.cuts += 1
                top = node.children.pop(first)
                spilled = Spilled(self.cuts, len(path) + 1, self._spilled_below(top))
                yield node, first, spilled, self._below(top, path)

    @staticmethod
    def _spilled_below(top: _Node) -> list[Spilled]:
        found, stack = [], [top]
        while stack:
            for child in stack.pop().children.values():
                (found if isinstance(child, Spilled) else stack).append(child)
        return found

    @staticmethod
    def _size(top: _Node) -> int:
        total, stack = 0, [top]
        while stack:
            node = stack.pop()
            total += len(node.label) + _NODE_BYTES
            stack.extend(c for c in node.children.values() if isinstance(c, _Node))
        return total


Row = tuple[bytes, bytes, int | None, int]


class _Spills:
    """Rows of spilled subtrees, in files of a task's own folder."""

    def __init__(self, folder: str):
        self.folder, self.count = folder, 0
        self.held: dict[int, bytearray] = {}
        self.bytes = 0

    def add(self, spilled: Spilled) -> None:
        """Number a subtree anew, over all tries of the task."""
        self.count += 1
        spilled.number = self.count

    def write(self, spilled: Spilled, row: Row) -> None:
        text, digest, owner, count = row
        into = self.held.setdefault(spilled.number, bytearray())
        into += struct.pack("<qqq?", len(text), owner or 0, count, owner is not None) + digest
        into += text
        self.bytes += len(text) + 57
        if self.bytes > _HELD_BYTES:
            self.flush()

    def flush(self) -> None:
        for number, rows in self.held.items():
            with open(f"{self.folder}/{number}", "ab") as file:
                file.write(rows)
        self.held, self.bytes = {}, 0

    def read(self, spilled: Spilled) -> Iterator[Row]:
        """All rows, also those of what was spilled inside; files are removed when they are read."""
        stack = [spilled]
        while stack:
            next_one = stack.pop()
            stack += next_one.inner
            path = f"{self.folder}/{next_one.number}"
            if not os.path.exists(path):  # a subtree of nothing but spilled ones
                continue
            with open(path, "rb") as file:
                while head := file.read(25):
                    length, owner, count, known = struct.unpack("<qqq?", head)
                    digest = file.read(32)
                    yield file.read(length), digest, owner if known else None, count
            os.remove(path)


def owners(rows: Iterator[Row], largest: bool, limit: int = TRIE_BYTES) -> Iterator[Row]:
    """One row (text, digest, owner, rows) per distinct text, in memory bounded by ``limit``.

    A trie that grows beyond it spills subtrees below its first branch; later texts that belong
    there follow. Each file is then worked off by a trie that starts behind the bytes its texts
    share, so neither long common beginnings nor deep nesting take more memory. The files are in
    the task's own temporary folder: a task that is run again makes them again.
    """
    with tempfile.TemporaryDirectory() as folder:
        spills = _Spills(folder)
        work: list[tuple[Iterator[Row], int]] = [(rows, 0)]
        while work:
            source, skip = work.pop()
            trie = PatriciaTrie(largest, skip)
            cut: dict[int, Spilled] = {}
            for text, digest, owner, count in source:
                spilled = trie.insert(text, digest, owner, count)
                if spilled is not None:
                    spills.write(spilled, (text, digest, owner, count))
                elif trie.bytes > limit:
                    for node, first, spilled, entries in trie.cut(limit // 2):
                        spills.add(spilled)
                        node.children[first] = cut[spilled.number] = spilled
                        for inside in spilled.inner:
                            del cut[inside.number]
                        for whole, (d, o, n) in entries:
                            spills.write(spilled, (whole, d, o, n))
            for whole, (digest, owner, count) in trie.entries():
                yield whole, digest, owner, count
            del trie
            spills.flush()
            work += [(spills.read(c), c.shared) for c in cut.values()]


def _batches(rows: Iterator[Row], with_text: bool, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    kept, held = [], 0

    def batch() -> pa.RecordBatch:
        texts, digests, ids, counts = zip(*kept)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(digests, pa.binary()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array(texts if with_text else [None] * len(texts), pa.binary()),
                pa.array(ids, pa.int64()),
                pa.array(counts, pa.int64()),
            ],
            ["text_sha256", "length", "text", "keep_id", "group_size"],
        )

    for row in rows:
        kept.append(row)
        held += len(row[0]) + 200
        if held > size:
            yield batch()
            kept, held = [], 0
    if kept:
        yield batch()


def normalised(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased, null as empty."""
    return pc.ascii_lower(plain_texts(texts))


def _digests(texts: pa.Array) -> list[bytes]:
    return [hashlib.sha256(t).digest() for t in texts.cast(pa.binary()).to_pylist()]


def text_owners(docs: DataFrame, largest: bool = False, limit: int = TRIE_BYTES) -> DataFrame:
    """One row (text_sha256, length, keep_id, group_size) per distinct normalised text.

    Every task first owns the texts it reads in a trie of its own, so a group of copies sends at
    most a row per task and spill. The full byte strings then go to partitions by length and
    content hash, whose tries compare them byte by byte.
    """

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Row]:
            for part in parts(batches, "text"):
                texts = normalised(part.column(1)).cast(pa.binary()).to_pylist()
                for text, owner in zip(texts, part.column(0).to_pylist()):
                    yield text, hashlib.sha256(text).digest(), owner, 1

        yield from giving_back(_batches(_partial_owners(rows(), largest, limit), True))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[Row]:
            names = ("text", "text_sha256", "keep_id", "group_size")
            for part in parts(batches, "text"):
                yield from zip(*(part.column(n).to_pylist() for n in names))

        yield from giving_back(_batches(owners(rows(), largest, limit), False))

    rows = docs.select(F.col("doc_id").cast("bigint"), "text")
    local = rows.mapInArrow(partial, ROW)
    dealt = local.repartition("length", "text_sha256")
    return dealt.mapInArrow(final, ROW).drop("text")


def _partial_owners(rows: Iterator[Row], largest: bool, limit: int) -> Iterator[Row]:
    """As owners, but a spilled subtree goes on to the shuffle at once."""
    trie = PatriciaTrie(largest)
    for text, digest, owner, count in rows:
        trie.insert(text, digest, owner, count)
        if trie.bytes > limit:
            for _, _, _, entries in trie.cut(limit // 2):
                for whole, (d, o, n) in entries:
                    yield whole, d, o, n
    for text, (digest, owner, count) in trie.entries():
        yield text, digest, owner, count


def duplicate_classes(docs: DataFrame, largest: bool = False) -> DataFrame:
    """One row (doc_id, keep_id, group_size, kept, text_sha256) for every row of ``docs``.

    Texts are equal when identical after lower-casing A-Z; a null text is empty. The row with
    the smallest id of its group stays (``largest``: the largest). A null id loses against any
    other; in a group of null ids alone ``keep_id`` is null and all rows count as kept. Rows that
    repeat the winning id are all marked kept; drop_duplicates leaves one of them. Very long
    texts are compared in full. An empty table gives no rows; other columns are not read.

    Owners come from tries that compare full texts; rows then find theirs by length and SHA-256.
    A hot group is split by the adaptive skew join.
    """

    def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in giving_back(parts(batches, "text")):
            texts = normalised(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(_digests(texts), pa.binary()),
                    pc.cast(pc.binary_length(texts), pa.int64()),
                ],
                ["doc_id", "text_sha256", "length"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        digest_rows, "doc_id bigint, text_sha256 binary, length bigint"
    )
    owned = text_owners(docs, largest)
    joined = rows.join(owned, ["length", "text_sha256"])
    return joined.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("text_sha256")).alias("text_sha256"),
    )


def _row_key(text: Column, doc_id: Column) -> Column:
    """A row's id, length and digest as one text; a null id is an empty one."""

    @F.arrow_udf("string")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in giving_back(batches):
            keys: list[str] = []
            for start, stop in slices(texts):
                plain = normalised(texts.slice(start, stop - start))
                sizes = pc.binary_length(plain).to_pylist()
                keys += [f"{n}:{d.hex()}" for n, d in zip(sizes, _digests(plain))]
            yield pa.array(keys, pa.string())

    return _joined_key(doc_id, digest(text))


def _joined_key(doc_id: Column, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("bigint").cast("string"), F.lit("")), digest)


def drop_duplicates(docs: DataFrame, largest: bool = False) -> DataFrame:
    """Exactly one row of ``docs`` for each distinct text, with all its columns.

    It is the row of the winning id (see duplicate_classes); where several rows have that id and
    text, or all ids of a text are null, any one of them. Rows of one id and different texts are
    not mixed up. Input columns of any name come back as they were.

    Rows of one id and text are reduced to one in each task before they are shuffled; the winners
    then meet them in the same partitions, by id, length and digest.
    """
    winners = text_owners(docs, largest)
    digest = F.concat_ws(":", "length", F.lower(F.hex("text_sha256")))
    winners = winners.select(_joined_key(F.col("keep_id"), digest).alias("_key"))
    row = F.struct(*[docs[c] for c in docs.columns]).alias("_row")
    keyed = docs.select(_row_key(docs["text"], docs["doc_id"]).alias("_key"), row)
    unique = keyed.dropDuplicates(["_key"])
    return unique.join(winners, "_key", "left_semi").select("_row.*")
