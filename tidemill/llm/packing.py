"""Conflict-constrained best-fit packing of documents into training sequences.

Documents longer than a sequence fill whole sequences first; what is left of each document is
packed. The pieces are dealt evenly to groups of about GROUP documents, and a group is packed
from its longest piece to its shortest. Bins are kept in the order of their residual room and
carry one bitmap of the sources and one of the duplicate clusters they hold. The search for a
piece starts at the smallest residual that has room and goes on to the next larger one until a
bin without conflict is found: the tightest compatible bin. Without one a new bin is opened.

A group is a bounded amount of work whatever the input: the deal ignores ids, sources and
clusters, so neither a hot source nor a large cluster makes a group larger.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.shared import ascii_lower, stored
from tidemill.runtime import shuffle_partitions

CAPACITY = 8192
GROUP = 4096
GROUPS_PER_TASK = 16

_NAMES = ["doc_id", "piece", "start", "length", "bin_id", "bin_offset"]


class ResidualBins:
    """Open bins by residual room, with a bitmap of sources and one of clusters per bin."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []
        self.at: dict[int, list[int]] = {}
        self.room: list[int] = []
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _file(self, number: int) -> None:
        room = self.room[number]
        if room:
            if room not in self.at:
                insort(self.residuals, room)
                self.at[room] = []
            insort(self.at[room], number)

    def _take(self, number: int) -> None:
        room = self.room[number]
        own = self.at[room]
        own.remove(number)
        if not own:
            del self.at[room]
            self.residuals.pop(bisect_left(self.residuals, room))

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset of a piece; ``source`` and ``cluster`` are bits, 0 for none."""
        found = -1
        for i in range(bisect_left(self.residuals, length), len(self.residuals)):
            for number in self.at[self.residuals[i]]:
                if not (self.sources[number] & source or self.clusters[number] & cluster):
                    found = number
                    break
            if found >= 0:
                self._take(found)
                break
        else:
            found = len(self.room)
            self.room.append(self.capacity)
            self.sources.append(0)
            self.clusters.append(0)
        offset = self.capacity - self.room[found]
        self.room[found] -= length
        self.sources[found] |= source
        self.clusters[found] |= cluster
        self._file(found)
        return found, offset


def pack_group(rows: list[tuple], capacity: int) -> list[tuple]:
    """``(doc_id, piece, start, length, bin, offset)`` for rows ``(doc_id, length, source, cluster, uid)``."""
    bins, out = ResidualBins(capacity), []
    sources: dict = {}
    clusters: dict = {}

    def bit(known: dict, value) -> int:
        return 0 if value is None else 1 << known.setdefault(value, len(known))

    left = []
    for doc_id, length, source, cluster, uid in rows:
        if not length or length < 0:
            out.append((doc_id, 0, 0, 0, None, None))
            continue
        full, rest = divmod(length, capacity)
        for piece in range(full):
            number, offset = bins.place(capacity, 0, 0)
            out.append((doc_id, piece, piece * capacity, capacity, number, offset))
        if rest:
            left.append((-rest, uid, doc_id, full, source, cluster))
    for rest, _, doc_id, piece, source, cluster in sorted(left, key=lambda r: r[:2]):
        number, offset = bins.place(-rest, bit(sources, source), bit(clusters, cluster))
        out.append((doc_id, piece, piece * capacity, -rest, number, offset))
    return out


def pack(rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``doc_id, piece, start, length, bin_id, bin_offset`` for ``doc_id, length, source, cluster``.

    A bin holds at most ``capacity`` and no two pieces of one source or one cluster; a null
    source or cluster is in conflict with nothing. Full pieces of a long document fill bins of
    their own. A row without a positive length gets one row with length 0 and a null bin.
    Repeated rows and null ids are packed like any other row; other columns are not read. Equal
    lengths are packed in the order of the stored rows.
    """
    wanted = rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("length").cast("bigint").alias("length"),
        F.col("source").cast("string").alias("source"), F.col("cluster").cast("bigint").alias("cluster"),
        F.monotonically_increasing_id().alias("uid"),
    )
    kept = stored(wanted, "to-pack")
    groups = max(1, -(-kept.count() // group))
    # Bins of a group are numbered within 2 ** 32.
    dealt = kept.withColumn("part", F.pmod(F.xxhash64("uid"), F.lit(groups)))

    def run(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        rows = zip(*(table.column(c).to_pylist() for c in ("doc_id", "length", "source", "cluster", "uid")))
        columns = list(zip(*pack_group(list(rows), capacity)))
        columns[4] = [None if number is None else (part << 32) | number for number in columns[4]]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=_NAMES)

    # Given explicitly, the number of tasks is not lowered for rows of few bytes: the work is in the search.
    spread = dealt.repartition(min(groups, max(shuffle_partitions(dealt), groups // GROUPS_PER_TASK)), "part")
    return spread.groupBy("part").applyInArrow(run, ", ".join(f"{name} bigint" for name in _NAMES))


def byte_length(text: Column) -> Column:
    """Length in byte-level tokens with one end token; null has none but the end token."""
    return F.coalesce(F.octet_length(text), F.lit(0)) + 1


def pack_documents(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pack`` for whole documents as byte-level tokens.

    The cluster of a document is its text with A-Z lower-cased and white space collapsed.
    """
    plain = F.trim(F.regexp_replace(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), r"[\x20\x09-\x0D]+", " "))
    return pack(
        docs.select("doc_id", byte_length(F.col("text")).alias("length"), "source", F.xxhash64(plain).alias("cluster")), capacity
    )
