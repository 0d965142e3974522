"""Best-fit packing of tokenised documents into fixed-length sequences.

``tokenize`` turns every whole text into pieces of at most ``capacity``
tokens. Packing depends on piece lengths only, so the instance is the
histogram of lengths (at most ``capacity`` numbers, whatever the corpus), and
all pieces of a length are handled as a multiplicity:

1. ``reduce_instance`` applies the Martello-Toth dominance criteria: from the
   longest piece on it permanently fixes the sets of one, two or three pieces
   that dominate every other set holding that piece, and shrinks the instance
   until nothing more can be fixed.
2. ``best_fit`` packs what is left by best fit, longest first.

Both give runs (a pattern of lengths, how often it is used). The ranks of
the pieces of a length are laid on the runs' slots: the rank of a piece is
(pieces of that length in earlier tasks) + (rank within its task), so no piece
is collected and nothing is sorted.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from knnrec.llm.common import prepare, stage, task_id

END_ID = 2
SPECIAL = {"<|endoftext|>": 50256}
_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The byte-level BPE of ``vocabulary`` (a rank file; ids equal those of
    the JSON form of the same vocabulary, which tests compare)."""
    if vocabulary not in _encoders:
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(vocabulary), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[vocabulary] = tiktoken.Encoding(
            vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
        )
    return _encoders[vocabulary]


#: The rank file's pattern backtracks over white space; its stack holds some
#: 10^6 characters. Texts with a run this long go through the JSON form.
LONG_SPACE = 50_000
_LONG_SPACE = re.compile(r"\s{%d}" % LONG_SPACE)
_json_encoders: dict[str, object] = {}


def json_encoder(vocabulary: str):
    """The JSON form of the same vocabulary: slower, without that limit."""
    if vocabulary not in _json_encoders:
        import public_tokenizers
        from tokenizers import Tokenizer

        _json_encoders[vocabulary] = Tokenizer.from_file(public_tokenizers.path(vocabulary.replace(".tiktoken", ".json")))
    return _json_encoders[vocabulary]


def has_long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and _LONG_SPACE.search(text) is not None


def ids_of(vocabulary: str) -> Callable[[str], list[int]]:
    """The ids of a text, whatever runs of white space it holds."""
    encode = encoder(vocabulary).encode

    def ids(text: str) -> list[int]:
        if has_long_space(text):
            return json_encoder(vocabulary).encode(text, add_special_tokens=False).ids
        return encode(text, allowed_special="all")

    return ids


PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()), ("task", pa.int64()), ("rank", pa.int64()),
])


def tokenize(docs: DataFrame, capacity: int, vocabulary: str) -> DataFrame:
    """One row per piece. ``rank`` counts the pieces of its length in its task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, task = ids_of(vocabulary), np.zeros(capacity + 1, np.int64), task_id()
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in PIECES}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*encode(text.as_py() or ""), END_ID], dtype="<u4")
                first = (len(ids) - 1) % capacity + 1
                for k, end in enumerate(range(first, len(ids) + 1, capacity)):
                    start = 0 if k == 0 else end - capacity
                    out["doc_id"].append(doc_id)
                    out["piece"].append(k)
                    out["start"].append(start)
                    out["length"].append(end - start)
                    out["ids_crc32"].append(zlib.crc32(ids[start:end].tobytes()))
                    out["task"].append(task)
                    out["rank"].append(int(seen[end - start]))
                    seen[end - start] += 1
            yield pa.RecordBatch.from_pydict(out, schema=PIECES)

    return docs.mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, task long, rank long"
    )


Run = tuple[dict[int, int], int]


def reduce_instance(counts: np.ndarray, capacity: int) -> list[Run]:
    """Fix dominating sets; ``counts[length]`` (changed in place) keeps what is
    left. For the longest piece ``j`` not yet passed over, with room
    ``r = capacity - j``, ``k`` the longest other piece that fits:

    - nothing fits: {j};
    - no two others fit, or k fills the room: {j, k};
    - no three others fit, and every fitting pair (a, b) has a + b <= k: {j, k};
    - no three others fit, b the longest that fits beside j and k, and no
      fitting pair lies wholly above b: {j, k, b}.

    A set is fixed as often as the criterion stays true, so each step empties
    a length or leaves only a few of its pieces.
    """
    runs: list[Run] = []

    def longest(room: int) -> int:
        room = min(room, capacity)
        found = np.flatnonzero(counts[1 : room + 1]) if room > 0 else []
        return int(found[-1]) + 1 if len(found) else 0

    def smallest(n: int) -> list[int]:
        out: list[int] = []
        for length in np.flatnonzero(counts):
            out += [int(length)] * int(min(counts[length], n - len(out)))
            if len(out) == n:
                break
        return out

    def largest_pair(room: int, above: int = 0) -> int:
        """The largest sum of two pieces (longer than ``above``) within room."""
        best = 0
        for a in np.flatnonzero(counts[: room + 1]):
            a = int(a)
            if a <= above or 2 * a > room:
                continue
            counts[a] -= 1
            b = longest(room - a)
            counts[a] += 1
            if b >= a and b > above:
                best = max(best, a + b)
        return best

    def fix(items: list[int]) -> None:
        pattern: dict[int, int] = defaultdict(int)
        for x in items:
            pattern[x] += 1
        # Leave a few pieces of each length so that the criterion, which looks
        # at up to four pieces, holds for every set of the batch; the last
        # ones are fixed singly.
        times = max(1, min(int(counts[x] - 4) // n for x, n in pattern.items()))
        for x, n in pattern.items():
            counts[x] -= times * n
        runs.append((dict(pattern), times))

    for j in range(capacity, 0, -1):
        while counts[j] > 0:
            counts[j] -= 1
            room = capacity - j
            k, few = longest(room), smallest(3)
            chosen = None
            if not k:
                chosen = [j]
            elif k == room or len(few) < 2 or few[0] + few[1] > room:
                chosen = [j, k]
            elif len(few) < 3 or sum(few) > room:
                if largest_pair(room) <= k:
                    chosen = [j, k]
                else:
                    counts[k] -= 1
                    b = longest(room - k)
                    counts[k] += 1
                    if b and not largest_pair(room, above=b):
                        chosen = [j, k, b]
            counts[j] += 1
            if chosen is None:
                break
            fix(chosen)
    return runs


def best_fit(counts: np.ndarray, capacity: int) -> list[Run]:
    """Best fit of the remaining pieces, longest first: a piece goes to the
    open sequence with the least room that holds it."""
    open_: dict[int, list[Run]] = defaultdict(list)
    for length in range(capacity, 0, -1):
        left = int(counts[length])
        counts[length] = 0
        for room in sorted(r for r in open_ if r >= length):
            each = room // length
            while left and open_[room]:
                pattern, times = open_[room].pop()
                full = min(times, left // each)
                if full:
                    open_[room - each * length].append(({**pattern, length: pattern.get(length, 0) + each}, full))
                    left -= full * each
                if full < times:
                    rest = times - full
                    if left:  # the last, partly filled sequence
                        open_[room - left * length].append(({**pattern, length: pattern.get(length, 0) + left}, 1))
                        left, rest = 0, rest - 1
                    if rest:
                        open_[room].append((pattern, rest))
                    break
            if not left:
                break
        each = capacity // length
        if left // each:
            open_[capacity - each * length].append(({length: each}, left // each))
        if left % each:
            open_[capacity - (left % each) * length].append(({length: left % each}, 1))
    return [run for runs in open_.values() for run in runs]


def lay_out(runs: list[Run], capacity: int) -> dict[str, np.ndarray]:
    """For each (length, run): first rank, first sequence, offset, pieces of
    that length in one sequence. Sorted by length, then first rank. Its size
    is bounded by the capacity, not by the corpus."""
    rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for pattern, times in runs:
        offset = 0
        for length in sorted(pattern, reverse=True):
            n = pattern[length]
            rows.append((length, int(rank[length]), sequence, offset, n))
            rank[length] += n * times
            offset += n * length
        sequence += times
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {
        name: table[:, i].copy() for i, name in enumerate(("length", "first_rank", "sequence", "offset", "per_sequence"))
    }


def solve(counts: np.ndarray, capacity: int) -> list[Run]:
    counts = counts.copy()
    return reduce_instance(counts, capacity) + best_fit(counts, capacity)


def pack(docs: DataFrame, capacity: int = 1024, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. A null or empty text is the end id alone; repeated rows are packed
    each for itself; equal lengths are interchangeable; an empty table gives
    no rows; other columns are ignored. A null doc_id stays null.
    """
    prepare(docs.sparkSession)
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = stage(tokenize(source, capacity, vocabulary), "pack-pieces")
    per_task = pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n"))
    per_task = stage(per_task, "pack-counts")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first_rank"))
    counts = np.zeros(capacity + 1, np.int64)
    for row in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # <= capacity rows
        counts[row["length"]] = row["n"]
    layout = lay_out(solve(counts, capacity), capacity)
    #: ranks of different lengths apart, for one search over both
    span = int(counts.max(initial=0)) + 1
    keys = layout["length"] * span + layout["first_rank"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            col = {name: batch.column(name) for name in batch.schema.names}
            length, rank = col["length"].to_numpy(), col["rank"].to_numpy() + col["first_rank"].to_numpy()
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            within = rank - layout["first_rank"][at]
            per = layout["per_sequence"][at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(col[c] for c in ("doc_id", "piece", "start", "length", "ids_crc32")),
                    pa.array(layout["sequence"][at] + within // per),
                    pa.array(layout["offset"][at] + within % per * length),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return pieces.join(first, ["task", "length"]).mapInArrow(
        place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    )
