"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A document's tokens end with the separator id. Documents longer than a sequence
are cut into full pieces; what is left over is the first piece. Pieces are then
numbers between 1 and the sequence length, so the whole corpus is described by
one count per length. The packing is made on that table, whose size is bounded
by the sequence length, and not on the pieces:

* a bin is filled greedily: the longest length that fits, again and again;
* then its smallest piece is taken out, and if two unpacked pieces fit the
  larger gap more tightly than it did, they take its place;
* the pattern so found is used as often as its lengths last.

Every piece gets a rank among those of its length: counts per length and hash
bucket give each bucket's first rank, and rows are numbered within a bucket, so
a length that a third of all pieces share is numbered by many tasks. Length and
rank name the place in the plan, which is a few numbers per pattern.

Null and empty texts are one piece, the separator alone. Each row is packed,
also repeated ones; a null id keeps its row. Extra columns are ignored; an empty
table packs into nothing.
"""

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from caseframe.llm.tokens import encoder
from caseframe.llm.work import texts, written

SEQUENCE = 2048
SEPARATOR_ID = 0
BUCKETS = 64
_ROWS = 256

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(length: int, sequence: int) -> list[tuple[int, int]]:
    """Start and length of a document's pieces; only the first may be shorter."""
    first = length % sequence or sequence
    return [(0, first), *((at, sequence) for at in range(first, length, sequence))]


def _pieces(path: str, sequence: int, with_ids: bool):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    end = np.array([SEPARATOR_ID], "<u4").tobytes()

    def run(frames):
        encode = encoder(path).encode
        for frame in frames:
            rows = []
            for at in range(0, len(frame), _ROWS):
                part = frame.iloc[at : at + _ROWS]
                for doc_id, packed in zip(part["doc_id"], encode(part["text"].tolist()), strict=True):
                    packed += end
                    for piece, (start, length) in enumerate(cut(len(packed) // 4, sequence)):
                        ids = packed[4 * start : 4 * (start + length)]
                        row = (doc_id, piece, start, length, zlib.crc32(ids))
                        rows.append((*row, np.frombuffer(ids, "<u4").astype("i4")) if with_ids else row)
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def best_two_fit(counts: np.ndarray, sequence: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Patterns as ([(length, uses), ...], bins) for ``counts[length]`` pieces of each length."""
    left = counts.astype(np.int64).copy()
    plan = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return plan
        used: dict[int, int] = {}
        gap = sequence

        def free(length, used=used):
            return left[length] - used.get(length, 0)

        places = len(there)
        while places and gap:
            places = int(np.searchsorted(there[:places], gap, side="right"))
            if not places:
                break
            length = int(there[places - 1])
            times = min(gap // length, int(free(length)))
            if times:
                used[length] = used.get(length, 0) + times
                gap -= times * length
            places -= 1
        if gap and sum(used.values()) > 1:
            smallest = min(used)
            room = gap + smallest
            open_lengths = there[there <= room]
            other = room - open_lengths
            # For each first piece the longest second one that fits beside it.
            second = np.searchsorted(open_lengths, other, side="right") - 1
            best, pair = smallest, None
            for first, at in zip(open_lengths.tolist(), second.tolist(), strict=True):
                at = min(at, int(np.searchsorted(open_lengths, first, side="right")) - 1)
                while at >= 0:
                    length = int(open_lengths[at])
                    if first + length <= best:
                        break
                    enough = free(first) >= 1 + (first == length) and free(length) >= 1
                    if enough:
                        best, pair = first + length, (first, length)
                        break
                    at -= 1
            if pair:
                used[smallest] -= 1
                if not used[smallest]:
                    del used[smallest]
                for length in pair:
                    used[length] = used.get(length, 0) + 1
        bins = min(int(left[length]) // times for length, times in used.items())
        pattern = sorted(used.items(), reverse=True)
        for length, times in pattern:
            left[length] -= times * bins
        plan.append((pattern, bins))


def _plan_table(counts: np.ndarray, sequence: int) -> pd.DataFrame:
    """Rows of ranks of one length: the sequence and offset of the first, uses per sequence."""
    rows, first_sequence, taken = [], 0, {}
    for pattern, bins in best_two_fit(counts, sequence):
        offset = 0
        for length, uses in pattern:
            rows.append((length, taken.get(length, 0), first_sequence, uses, offset))
            taken[length] = taken.get(length, 0) + bins * uses
            offset += length * uses
        first_sequence += bins
    table = pd.DataFrame(rows, columns=["length", "rank", "sequence", "uses", "offset"])
    return table.astype("int64").sort_values(["length", "rank"], ignore_index=True)


def _placed(plan: pd.DataFrame, columns: list[str]):
    stride = np.int64(1) << 40  # ranks of a length stay below
    keys = plan["length"].to_numpy() * stride + plan["rank"].to_numpy()
    first, sequence, uses, offset = (
        plan[name].to_numpy() for name in ("rank", "sequence", "uses", "offset")
    )

    def run(frames):
        for frame in frames:
            length, rank = frame["length"].to_numpy(), frame["rank"].to_numpy()
            at = np.searchsorted(keys, length * stride + rank, side="right") - 1
            turn = rank - first[at]
            yield frame.assign(
                sequence_id=sequence[at] + turn // uses[at],
                offset=offset[at] + turn % uses[at] * length,
            )[columns]

    return run


def pack(
    documents: DataFrame,
    tokenizer: str,
    sequence: int = SEQUENCE,
    with_ids: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id``, ``offset``.

    ``tokenizer`` is the vocabulary file. With ``with_ids`` the token ids of each
    piece come along. The length table and the plan are all that the driver sees:
    one count per length, and patterns that each use up at least one length.
    """
    schema = PIECE + (", ids array<int>" if with_ids else "")
    pieces = written(texts(documents).mapInPandas(_pieces(tokenizer, sequence, with_ids), schema))
    spread = F.expr(f"cast(pmod(xxhash64(doc_id, piece, ids_crc32), {buckets}) as int)")
    dealt = pieces.withColumn("bucket", spread)
    table = dealt.groupBy("length", "bucket").count().toPandas()  # sequence x buckets rows at most
    table = table.sort_values(["length", "bucket"])
    counts = np.zeros(sequence + 1, np.int64)
    np.add.at(counts, table["length"].to_numpy(np.int64), table["count"].to_numpy(np.int64))
    table["first"] = table.groupby("length")["count"].cumsum() - table["count"]
    plan = _plan_table(counts, sequence)
    spark = documents.sparkSession
    firsts = spark.createDataFrame(
        table[["length", "bucket", "first"]].astype("int64"), "length long, bucket int, first long"
    )
    in_bucket = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("row", F.row_number().over(in_bucket)).join(
        F.broadcast(firsts), ["length", "bucket"]
    )
    columns = [field.strip().split(" ")[0] for field in schema.split(",")]
    ranked = ranked.select(*columns, (F.col("first") + F.col("row") - 1).alias("rank"))
    return ranked.mapInPandas(
        _placed(plan, [*columns, "sequence_id", "offset"]),
        f"{schema}, sequence_id long, offset long",
    )
