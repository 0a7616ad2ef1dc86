"""Pack documents into sequences of a fixed length, mixing their sources in given proportions."""

from __future__ import annotations

import bisect
import functools
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.arrow import CHUNK_BYTES, batches_of_bytes, tidied
from nearkin.llm.columns import text_or_empty
from nearkin.llm.bpe import codec
from nearkin.session import stored

SEQUENCE_TOKENS = 2048
WINDOW_TOKENS = 32 * SEQUENCE_TOKENS
#: Queues of a mixture; of more sources, those with the fewest tokens share SHARED_QUEUES of them.
MAX_QUEUES, SHARED_QUEUES = 512, 64
#: Counts that a schedule keeps of windows it has looked at: so many windows times queues.
KEPT_COUNTS = 1_000_000


def tokenise(
    docs: DataFrame,
    path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """``doc_id, source, chunk, before, n_tokens, ids`` of every document, ``end_id`` appended.

    ``chunk`` is the task that read the row and ``before`` the tokens of the same source that
    came earlier in it: each source is a queue in the order (chunk, before).
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
        text_or_empty(text_col).alias("text"),
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, chunk = codec(path).encode, TaskContext.get().partitionId()
        served: dict[str, int] = {}
        for batch in batches_of_bytes(batches, "text", CHUNK_BYTES):
            ids, before = [], []
            for text, source in zip(batch.column("text"), batch.column("source").to_pylist(), strict=True):
                ids.append(encode(text.as_py()) + end)
                before.append(served.get(source, 0))
                served[source] = before[-1] + len(ids[-1]) // 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("source"),
                    pa.array([chunk] * len(ids), pa.int32()),
                    pa.array(before, pa.int64()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "source", "chunk", "before", "n_tokens", "ids"],
            )

    return rows.mapInArrow(
        tidied(run), f"doc_id {kind}, source string, chunk int, before long, n_tokens long, ids binary"
    )


class Schedule:
    """Which tokens of each queue every window takes.

    Deficit round-robin with a credit per window of its target share: by the end of window w a
    queue has been served its share of w windows, rounded to a token, and what the rounding
    keeps back or gives ahead is the deficit that the next window starts from. As documents may
    be cut, the served amount is known without serving: window w takes from the queue of n
    tokens, in a phase of N, those whose middle lies at w windows' share. A phase ends when a
    queue is empty; the others go on with their shares of what remains.
    """

    def __init__(self, totals: dict[str, int], weights: dict[str, float] | None, window: int):
        self.window = window
        self.sources = sorted(s for s, n in totals.items() if n)
        self.place = {s: i for i, s in enumerate(self.sources)}
        left = [totals[s] for s in self.sources]
        share = [
            Fraction(totals[s]) if weights is None else Fraction(weights.get(s, 0)).limit_denominator(10**9)
            for s in self.sources
        ]
        #: Of each phase: its first window, its first token, and each queue's first token and count.
        self.phases: list[tuple[int, int, list[int], list[int]]] = []
        start, at, done = 0, 0, [0] * len(left)
        while any(left):
            active = [i for i, n in enumerate(left) if n]
            if all(share[i] <= 0 for i in active):
                share = [Fraction(n) for n in left]
            active = [i for i in active if share[i] > 0]
            rounds = min(Fraction(left[i]) / share[i] for i in active)
            taken = [0] * len(left)
            for i in active:
                taken[i] = min(left[i], int(rounds * share[i]))
            self.phases.append((start, at, list(done), taken))
            at += sum(taken)
            start += -(-sum(taken) // window)
            done = [d + t for d, t in zip(done, taken, strict=True)]
            left = [n - t for n, t in zip(left, taken, strict=True)]
        self.total = at
        #: Of each queue: the phases that take from it, and its first token in each.
        self.own = [
            [p for p, (_, _, _, taken) in enumerate(self.phases) if taken[i]] for i in range(len(self.sources))
        ]
        self.firsts = [[self.phases[p][2][i] for p in own] for i, own in enumerate(self.own)]
        kept = max(16, KEPT_COUNTS // max(1, len(self.sources)))
        self._served = functools.lru_cache(maxsize=kept)(self._served_by)

    def _served_by(self, phase: int, window: int) -> tuple[list[int], int]:
        """Tokens of every queue that come before a window of the phase, and their sum."""
        taken = self.phases[phase][3]
        whole = sum(taken)
        time = min(window * self.window, whole)
        served = [self._exact(n, time, whole) for n in taken]
        return served, sum(served)

    @staticmethod
    def _exact(n: int, time: int, whole: int) -> int:
        """The number of tokens c with (2c + 1) * whole <= 2 * time * n."""
        if time == whole:
            return n
        return min(n, (2 * time * n // whole + 1) // 2)

    def pieces(self, source: str, first: int, count: int) -> Iterator[tuple[int, int, int]]:
        """Offset, place in the whole layout, and length of the parts of a queue's tokens."""
        queue, offset = self.place[source], 0
        while offset < count:
            token = first + offset
            phase = self.own[queue][bisect.bisect_right(self.firsts[queue], token) - 1]
            _, at, done, taken = self.phases[phase]
            token -= done[queue]
            whole, n = sum(taken), taken[queue]
            window = (2 * token + 1) * whole // (2 * n * self.window)
            while self._served(phase, window)[0][queue] > token:
                window -= 1
            while self._served(phase, window + 1)[0][queue] <= token:
                window += 1
            before, base = self._served(phase, window)
            after, _ = self._served(phase, window + 1)
            place = at + base + sum(after[:queue]) - sum(before[:queue]) + token - before[queue]
            length = min(count - offset, after[queue] - token)
            yield offset, place, length
            offset += length


#: What a queue's name begins with: that of one source, and a shared one.
OWN, SHARED = "s", "t"


def _queues(per_chunk: DataFrame, named: set[str]) -> DataFrame:
    """``per_chunk`` with the ``queue`` that each source goes to."""
    own = F.concat(F.lit(OWN), "source")
    if per_chunk.select("source").distinct().count() <= MAX_QUEUES:
        return per_chunk.withColumn("queue", own)
    if len(named) > MAX_QUEUES - SHARED_QUEUES:
        raise ValueError(f"a mixture names at most {MAX_QUEUES - SHARED_QUEUES} sources")
    is_named = F.col("source").isin(*named) if named else F.lit(False)
    by_source = per_chunk.groupBy("source").agg(F.sum("n").alias("total"))
    largest = stored(
        by_source.orderBy(is_named.desc(), F.desc("total"), "source").limit(MAX_QUEUES - SHARED_QUEUES)
        .select("source", F.lit(True).alias("large")),
        "packing-largest",
    )
    shared = F.concat(F.lit(SHARED), F.pmod(F.xxhash64("source"), F.lit(SHARED_QUEUES)))
    return per_chunk.join(F.broadcast(largest), "source", "left").select(
        *per_chunk.columns, F.when(F.col("large"), own).otherwise(shared).alias("queue")
    )


def pack(
    tokens: DataFrame,
    weights: dict[str, float] | None = None,
    sequence_tokens: int = SEQUENCE_TOKENS,
    window_tokens: int = WINDOW_TOKENS,
) -> DataFrame:
    """Lay the stored result of ``tokenise`` out in sequences; one row per piece of a document.

    Columns: ``doc_id, source, start, length, doc_tokens, sequence_id, offset, padded_to, ids``.
    Every window of ``window_tokens`` holds the sources in the proportions of ``weights`` (by
    default those of the corpus, so that all queues end together), to within a token a source,
    across tasks: a queue's place depends on the token counts of the tasks before, one row per
    task and source. Sources that ``weights`` does not name follow after the named ones. Only
    the last sequence of all is not full; it is padded to the next power of two. Ties and
    repeated rows are documents of their own; a null source is the empty name; an empty table
    packs to an empty one. A mixture has MAX_QUEUES queues at most: of more sources, the smallest
    that ``weights`` does not name share queues, in which they stand one after the other in each
    task's part; all are packed.
    """
    per_chunk = stored(
        tokens.groupBy("chunk", "source").agg(F.sum("n_tokens").alias("n")), "packing-chunks"
    )
    queued = _queues(per_chunk, set(weights or ()))
    earlier = Window.partitionBy("queue").orderBy("chunk", "source").rowsBetween(Window.unboundedPreceding, -1)
    queues = stored(
        queued.select(
            "chunk", "source", "queue", "n", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("chunk_start")
        ),
        "packing-queues",
    )
    # One row for each queue, of which there are MAX_QUEUES at most.
    totals = {r["queue"]: r["n"] for r in queues.groupBy("queue").agg(F.sum("n").alias("n")).collect()}
    named = None if weights is None else {f"{OWN}{source}": share for source, share in weights.items()}
    schedule_of = (totals, named, window_tokens)
    kind = tokens.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schedule = Schedule(*schedule_of)
        full, rest = divmod(schedule.total, sequence_tokens)
        last = 1 << max(0, rest - 1).bit_length()
        names = ["doc_id", "source", "start", "length", "doc_tokens", "sequence_id", "offset", "padded_to", "ids"]
        for batch in batches_of_bytes(batches, "ids", CHUNK_BYTES):
            rows, source_rows = [], []
            columns = [batch.column(c).to_pylist() for c in ("queue", "queue_start", "n_tokens", "ids")]
            for row, (queue, first, count, ids) in enumerate(zip(*columns, strict=True)):
                for offset, place, length in schedule.pieces(queue, first, count):
                    while length:
                        sequence, inside = divmod(place, sequence_tokens)
                        part = min(length, sequence_tokens - inside)
                        padded = sequence_tokens if sequence < full else last
                        cut = ids[4 * offset : 4 * (offset + part)]
                        rows.append((offset, part, count, sequence, inside, padded, cut))
                        source_rows.append(row)
                        offset, place, length = offset + part, place + part, length - part
            taken = pa.array(source_rows, pa.int64())
            values = list(zip(*rows, strict=True)) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(taken), batch.column("source").take(taken)]
                + [pa.array(v, pa.int64()) for v in values[:6]]
                + [pa.array(values[6], pa.binary())],
                names=names,
            )

    placed = tokens.join(queues.drop("n"), ["chunk", "source"]).select(
        "doc_id", "source", "queue", (F.col("chunk_start") + F.col("before")).alias("queue_start"), "n_tokens", "ids"
    )
    return placed.mapInArrow(
        tidied(run),
        f"doc_id {kind}, source string, start long, length long, doc_tokens long, "
        "sequence_id long, offset long, padded_to long, ids binary",
    )


def pack_documents(docs: DataFrame, path: str, weights: dict[str, float] | None = None) -> DataFrame:
    """Tokenise once into a stored table, then pack it."""
    return pack(stored(tokenise(docs, path), "packing-tokens"), weights)
