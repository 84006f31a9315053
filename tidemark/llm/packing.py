"""Best-fit packing by bin completion: undominated fillings around the largest piece, branch and bound over them.

Pieces of one length are alike, so the search runs on the histogram of lengths, which has at most `capacity` entries however
many documents there are. The best-fit decreasing packing is the first incumbent. A node of the search takes the largest
length left and completes a sequence around it: its children are the undominated fillings of the room, the least waste first
and few pieces before many, each repeated as often as the counts allow, and then each once, which makes the search complete.
Fillings are enumerated lazily, at every size alike; only the number of steps bounds the search (STEPS), and the bound on the
waste prunes it. A descent has thousands of nodes; what they enumerate from is kept for the deepest few (LIVE) alone.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm._shared import ship, text_chunks, written
from tidemark.llm._tokens import default_tokenizer_path, encoder_of, read_tokenizer
from tidemark.llm.token_output import bits_for, pack

CAPACITY = 4096
#: Steps that the search may take beyond its first descent: nodes opened and fillings looked at.
STEPS = 20_000
#: The deepest nodes of the search, which keep their tables (up to 3 MB each); others compute them again on return.
LIVE = 16
PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, ids binary, part int, nth long"
Filling = tuple[tuple[int, int], ...]


def _histogram(counts: dict[int, int], capacity: int) -> np.ndarray:
    out = np.zeros(capacity + 1, np.int64)
    for n, k in counts.items():
        out[n] = k
    return out


def _bound(have: np.ndarray) -> int:
    """Sequences that any packing of the histogram needs (Martello and Toth's L2): for every least size a, pieces over
    capacity - a are alone, those over half are apart, and the others from a on fill what these leave or need more."""
    capacity = len(have) - 1
    half = capacity // 2
    number = np.concatenate([[0], np.cumsum(have)])  # of pieces below a length
    tokens = np.concatenate([[0], np.cumsum(have * np.arange(capacity + 1))])
    a = np.arange(half + 1)
    apart = number[-1] - number[half + 1]  # pieces over half
    wide = number[-1] - number[capacity - a + 1]  # over capacity - a
    free = (apart - wide) * capacity - (tokens[capacity - a + 1] - tokens[half + 1])
    rest = tokens[half + 1] - tokens[a]
    return int((apart + np.maximum(0, -(-(rest - free) // capacity))).max())


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs."""
    return _bound(_histogram(counts, capacity))


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """The best-fit decreasing packing, on the histogram: a length's pieces go where the least room is left that takes them."""
    rooms: list[int] = []  # in order
    bins: dict[int, list[list]] = {}  # by room: [pieces, times]

    def add(room: int, pieces: list[tuple[int, int]], times: int) -> None:
        if room not in bins:
            bins[room] = []
            bisect.insort(rooms, room)
        bins[room].append([pieces, times])

    for n, k in sorted(counts.items(), reverse=True):
        while k:
            at = bisect.bisect_left(rooms, n)
            if at == len(rooms):
                add(capacity, [], k)
                continue
            room = rooms[at]
            pieces, times = bins[room][-1]
            # A sequence that takes one has the least room for the next, so it takes what it can.
            each = min(room // n, k)
            used = min(times, k // each)
            bins[room][-1][1] -= used
            if bins[room][-1][1] == 0:
                bins[room].pop()
                if not bins[room]:
                    del bins[room]
                    rooms.pop(at)
            add(room - each * n, [*pieces, (n, each)], used)
            k -= each * used
    found = [(tuple(pieces), times) for groups in bins.values() for pieces, times in groups if pieces]
    return sorted(found, reverse=True)


def _with_copies(reach: int, n: int, k: int, mask: int) -> int:
    """The sums of a set of sums and up to k pieces of length n, as bits of one integer."""
    step = 1
    while k > 0:
        take = min(step, k)
        reach |= (reach << (n * take)) & mask
        k -= take
        step *= 2
    return reach


def _smeared(bits: int, gap: int) -> int:
    """Every bit, and the `gap` places above it."""
    done = 0
    while done < gap:
        step = min(done + 1, gap - done)
        bits |= bits << step
        done += step
    return bits


def _dominated(filling: Filling, gap: int, spare: int, mask: int) -> bool:
    """Whether another filling dominates: whether some spare length can take the place of pieces that fit in it together,
    or of none, within the room. `spare`: lengths of which a piece is left, as bits; gap: the room left."""
    one = many = 0  # sums of one piece, and of two or more
    for n, k in filling:
        many = _with_copies(many, n, k, mask) | _with_copies(one, n, k - 1, mask) << n | (_with_copies(1, n, k - 2, mask) << 2 * n if k > 1 else 0)
        one |= 1 << n
    placed = _smeared(many, gap)
    if gap:
        # Of one piece's place a longer one makes better use; and in the room left there may be place for one more.
        placed |= _smeared((one | 1) << 1, gap - 1)
    return bool(placed & spare)


class Tables:
    """What the fillings of a room are looked up in. Computed when needed, from the histogram that the room can be filled
    from, and again after `release`, for which the histogram has to be the same whenever it is asked for."""

    def __init__(self, histogram: Callable[[], np.ndarray], room: int):
        self.histogram, self.room, self.mask = histogram, room, (1 << (room + 1)) - 1

    def release(self) -> None:
        for name in ("have", "lengths", "spare", "high", "sizes", "suffix"):
            vars(self).pop(name, None)

    @cached_property
    def have(self) -> np.ndarray:
        return self.histogram()[: self.room + 1]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.flatnonzero(self.have)

    @cached_property
    def spare(self) -> int:
        """Lengths as bits."""
        return int.from_bytes(np.packbits(self.have > 0, bitorder="little").tobytes(), "little")

    @cached_property
    def high(self) -> np.ndarray:
        """The longer lengths of pairs that leave no waste, descending."""
        high = self.lengths[(2 * self.lengths >= self.room) & (self.lengths < self.room)][::-1]
        return high[self.have[self.room - high] > (2 * high == self.room)]

    @cached_property
    def sizes(self) -> list[tuple[int, int]]:
        """(length, how many the room takes), descending."""
        down = self.lengths[::-1]
        return [(n, min(k, self.room // n)) for n, k in zip(down.tolist(), self.have[down].tolist(), strict=True)]

    @cached_property
    def suffix(self) -> list[int]:
        """Of each k, the sums that the lengths from the kth on (descending) reach."""
        suffix = [1] * (len(self.sizes) + 1)
        for k in range(len(self.sizes) - 1, -1, -1):
            suffix[k] = _with_copies(suffix[k + 1], *self.sizes[k], self.mask)
        return suffix

    def allowed(self, f: Filling) -> bool:
        left = self.spare
        for n, m in f:
            if self.have[n] == m:
                left &= ~(1 << n)
        return not _dominated(f, self.room - sum(n * m for n, m in f), left, self.mask)

    def pair(self, at: int) -> Filling | None:
        """The filling of two pieces with this one of `high`, where no other dominates it."""
        n = int(self.high[at])
        f = ((n, 1), (self.room - n, 1)) if 2 * n > self.room else ((n, 2),)
        return f if self.allowed(f) else None

    def further(self, k: int, rest: int, chosen: Filling) -> list[tuple[int, int, Filling]]:
        """The ways on from `chosen` to a sum that lacks `rest`, with the kth length or a shorter one; each leads to one."""
        sizes, suffix = self.sizes, self.suffix
        k = max(k, len(sizes) - int(np.searchsorted(self.lengths, rest, "right")))
        while True:
            n, m = sizes[k]
            copies = [j for j in range(min(m, rest // n) + 1) if suffix[k + 1] >> (rest - j * n) & 1]
            if copies != [0]:
                return [(k + 1, rest - j * n, (*chosen, (n, j)) if j else chosen) for j in copies]
            k += 1


def fillings(have: np.ndarray, room: int) -> Iterator[Filling | None]:
    """The undominated fillings of the room from the lengths that the histogram has, the least waste first, then few pieces
    before many. None stands for a step that gave nothing."""
    return _fillings(Tables(lambda: have, room))


def _fillings(tables: Tables) -> Iterator[Filling | None]:
    """Between two steps no table is held here, so that `tables` can be released."""
    room = tables.room
    if room < len(tables.have) and tables.have[room]:
        yield ((room, 1),)  # one piece as large as the room dominates all others
        return
    if not len(tables.lengths):
        yield ()
        return
    # Without waste, two pieces: no table of sums is needed to find them.
    for at in range(len(tables.high)):
        yield tables.pair(at)
    for goal in range(tables.suffix[0].bit_length() - 1, -1, -1):
        if tables.suffix[0] >> goal & 1:
            # Fillings with this sum, large pieces first; every path that is begun ends in one.
            stack: list[tuple[int, int, Filling]] = [(0, goal, ())]
            while stack:
                k, rest, chosen = stack.pop()
                if rest:
                    stack += tables.further(k, rest, chosen)
                    yield None
                elif goal == room and sum(m for _, m in chosen) == 2:
                    yield None
                else:
                    yield chosen if tables.allowed(chosen) else None


def pack_histogram(counts: dict[int, int], capacity: int = CAPACITY, steps: int = STEPS) -> list[tuple[Filling, int]]:
    """(filling, how often) so that every piece is packed, in as few sequences as the search finds, and never in more than
    best fit needs; each filling holds its largest piece first. A branch is pruned where the sequences so far and the bound
    on the rest don't beat the incumbent. Within `steps` the search is complete and the result optimal."""
    if any(n > capacity or n < 1 for n in counts):
        raise ValueError("a piece must have from 1 to capacity tokens")
    counts = {n: k for n, k in counts.items() if k > 0}
    best = best_fit(counts, capacity)
    best_n = sum(times for _, times in best)
    left = _histogram(counts, capacity)
    least = _bound(left)
    taken, descended = 0, False

    def others(first: int) -> np.ndarray:
        out = left.copy()
        out[first] -= 1
        return out

    def children(first: int, tables: Tables) -> Iterator[tuple[Filling, int] | None]:
        seen: list[Filling] = []
        for f in _fillings(tables):
            if f is None:
                yield None
                continue
            whole = dict(f)
            whole[first] = whole.get(first, 0) + 1
            seen.append(tuple(sorted(whole.items(), reverse=True)))
            yield seen[-1], min(int(left[n]) // m for n, m in seen[-1])
        for f in seen:
            if min(int(left[n]) // m for n, m in f) > 1:
                yield f, 1

    path: list[tuple[Filling, int]] = []
    stack: list[Iterator] = []
    held: list[Tables] = []  # of the stack's nodes
    used = 0
    while best_n > least:
        if not left.any():
            best, best_n = (list(path), used) if used < best_n else (best, best_n)
            descended = True
        elif used + _bound(left) < best_n and (taken < steps or not descended):
            first = int(np.flatnonzero(left)[-1])
            held.append(Tables(partial(others, first), capacity - first))
            stack.append(children(first, held[-1]))
            if len(held) > LIVE:
                held[-LIVE - 1].release()
            taken += descended
        else:
            descended = True
        # On to the next child of the deepest node that has one.
        child = None
        while stack:
            if len(path) == len(stack):
                f, times = path.pop()
                used -= times
                for n, m in f:
                    left[n] += m * times
            while (child := next(stack[-1], "none")) is None:
                taken += descended
                if taken >= steps and descended:
                    child = "none"
                    break
            if child != "none" and not (descended and taken >= steps):
                break
            child = None
            stack.pop()
            held.pop()
        if child is None:
            return best
        f, times = child
        for n, m in f:
            left[n] -= m * times
        used += times
        path.append(child)
    return best


@dataclass
class Layout:
    """Where the nth piece of a length goes. Runs in order of (length, first nth); at most capacity kinds of sequences."""

    key: np.ndarray  # length << 44 | first nth
    times: np.ndarray  # pieces of the length in a sequence
    sequence: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(packing: list[tuple[Filling, int]]) -> Layout:
        seen: dict[int, int] = {}
        rows, base = [], 0
        for filling, often in packing:
            at = 0
            for n, m in filling:
                rows.append((n << 44 | seen.get(n, 0), m, base, at))
                seen[n] = seen.get(n, 0) + m * often
                at += n * m
            base += often
        table = np.array(sorted(rows), np.int64).reshape(-1, 4)
        return Layout(*(table[:, k].copy() for k in range(4)))

    def place(self, length: np.ndarray, nth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.key, length << 44 | nth, "right") - 1
        i = (length << 44 | nth) - self.key[run]
        return self.sequence[run] + i // self.times[run], self.offset[run] + i % self.times[run] * length


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = 1, keep_ids: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of every whole text with end_id after it, written: ids are packed in the vocabulary's fewest bits
    (token_output.unpack). `part` and `nth` number the pieces of one length within a task's output."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast(read_tokenizer(tokenizer_path or default_tokenizer_path()))
    tail = np.array([end_id], np.uint32)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = encoder_of(model.value), TaskContext.get().partitionId()
        bits, seen = bits_for(max(encoder.vocab_size, end_id + 1)), np.zeros(capacity + 1, np.int64)
        for batch in text_chunks(batches, "text"):
            rows = []
            for doc_id, ids in zip(batch.column(1).to_pylist(), encoder.encode(batch.column(0)), strict=True):
                ids = np.concatenate([ids, tail])
                for k, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    rows.append((doc_id, k, start, len(own), zlib.crc32(own.astype("<u4").tobytes()), pack(own, bits) if keep_ids else None, part, int(seen[len(own)])))
                    seen[len(own)] += 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=[x.split()[0] for x in PIECES.split(", ")])

    narrow = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    return written(narrow.mapInArrow(cut, PIECES), "pieces")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer_path: str | None = None, end_id: int = 1, steps: int = STEPS, **columns: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset): every document's pieces in sequences of at most
    `capacity` tokens. Only documents of more tokens are cut.

    The histogram of lengths, at most `capacity` rows, is packed on the driver; every piece finds its place from its number
    among those of its length, which tasks count apart and a prefix sum over tasks joins. Null or empty text: the end id
    alone. Null ids are passed through; repeated rows are packed each. Empty input: empty result. Other columns are left out.
    """
    pieces = cut_pieces(docs, capacity, tokenizer_path, end_id, **columns)
    spark = docs.sparkSession
    held = written(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("k")), "lengths")
    counts = {r["length"]: r["k"] for r in held.groupBy("length").agg(F.sum("k").alias("k")).collect()}
    layout = spark.sparkContext.broadcast(Layout.of(pack_histogram(counts, capacity, steps)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = held.select("part", "length", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("base"))

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index
            length = batch.column(at("length")).to_numpy().astype(np.int64)
            sequence, offset = layout.value.place(length, batch.column(at("rank")).to_numpy())
            names = batch.schema.names[:-1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    ranked = pieces.select("doc_id", "piece", "start", "length", "ids_crc32", "part", "nth").join(bases, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length int, ids_crc32 long, sequence_id long, offset long")
