"""Frequency of every distinct term, in rows and in records, exactly.

Heavy terms are detected in one pass (Misra-Gries: every term above the support is found and at most 1/support terms are
kept, so what is broadcast has a fixed bound). Each task counts them in local arrays: rows per term, and the distinct
record numbers per block of 4096, which leave the task as one short row per term and block. Only the other terms are
shuffled row by row, none of which holds more than the support. The two count tables are united.

Defined results: null and blank terms are no terms; a null record counts as a row and as no record; repeated rows count
as rows but once as a record; terms count as stored, without trimming.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUPPORT = 1 / 500
BLOCK_BITS = 12
FLUSH_ROWS = 1_000_000


def heavy_terms(rows: DataFrame, support: float = SUPPORT) -> DataFrame:
    """(term, slot) of all terms above the support, at most 1/support of them."""
    found = rows.stat.freqItems(["term"], support).first()[0] or []
    slots = [(term, slot) for slot, term in enumerate(sorted(t for t in found if t is not None))]
    return rows.sparkSession.createDataFrame(slots, "term string, slot int")


def _local_counters(rows: DataFrame) -> DataFrame:
    """Of (slot, record) rows: rows, and distinct offsets in each block of records, as each task has counted them."""
    import numpy as np
    import pyarrow as pa

    out = pa.schema([
        ("slot", pa.int32()), ("block", pa.int64()), ("n_rows", pa.int64()), ("offsets", pa.list_(pa.int16()))
    ])

    def emit(slots: list, records: list) -> pa.RecordBatch:
        slot, record = np.concatenate(slots), np.concatenate(records)
        order = np.lexsort((record, slot))
        slot, record = slot[order], record[order]
        block = record >> BLOCK_BITS
        group = np.flatnonzero(np.r_[True, (slot[1:] != slot[:-1]) | (block[1:] != block[:-1])])
        first = np.r_[True, (slot[1:] != slot[:-1]) | (record[1:] != record[:-1])]
        kept = (record & ((1 << BLOCK_BITS) - 1))[first].astype(np.int16)
        bounds = np.r_[np.cumsum(first)[group] - 1, len(kept)].astype(np.int32)
        return pa.RecordBatch.from_arrays([
            pa.array(slot[group], pa.int32()), pa.array(block[group], pa.int64()),
            pa.array(np.diff(np.r_[group, len(slot)]), pa.int64()),
            pa.ListArray.from_arrays(pa.array(bounds), pa.array(kept)),
        ], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, records, waiting, nulls = [], [], 0, {}
        for part in batches:
            slot, record = part.column(0).to_numpy(zero_copy_only=False), part.column(1)
            known = record.is_valid().to_numpy(zero_copy_only=False)
            for s, n in zip(*np.unique(slot[~known], return_counts=True)):
                nulls[int(s)] = nulls.get(int(s), 0) + int(n)
            slots.append(slot[known])
            records.append(record.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
            waiting += len(slots[-1])
            if waiting >= FLUSH_ROWS:
                yield emit(slots, records)
                slots, records, waiting = [], [], 0
        if waiting:
            yield emit(slots, records)
        if nulls:
            yield pa.RecordBatch.from_pylist(
                [{"slot": s, "block": None, "n_rows": n, "offsets": []} for s, n in nulls.items()], schema=out
            )

    return rows.mapInArrow(run, "slot int, block bigint, n_rows bigint, offsets array<smallint>")


def term_frequencies(df: DataFrame, term: Column, record: Column, support: float = SUPPORT) -> DataFrame:
    """(term, n_rows, n_records) of every term."""
    rows = df.select(term.cast("string").alias("term"), record.cast("bigint").alias("record"))
    rows = rows.where(F.trim("term") != "")
    heavy = heavy_terms(rows, support)
    slotted = rows.join(F.broadcast(heavy), "term", "left")
    counted = _local_counters(slotted.where("slot is not null").select("slot", "record"))
    blocks = counted.groupBy("slot", "block").agg(
        F.sum("n_rows").alias("n_rows"),
        F.size(F.array_distinct(F.flatten(F.collect_list("offsets")))).cast("bigint").alias("n_records"),
    )
    weighty = blocks.groupBy("slot").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_records").alias("n_records"))
    weighty = weighty.join(F.broadcast(heavy), "slot").select("term", "n_rows", "n_records")
    # partial sums before either exchange; the first is by term and record, so no term is a task of its own
    light = slotted.where("slot is null").groupBy("term", "record").agg(F.count("*").alias("n"))
    light = light.groupBy("term").agg(F.sum("n").alias("n_rows"), F.count("record").alias("n_records"))
    return weighty.unionByName(light)


def marked(counts: DataFrame, n_papers: Column, rarest: int = 10, commonest: float = 0.5) -> DataFrame:
    """Adds ``mark``: rare below ``rarest`` records, common above the share ``commonest`` of all, else null."""
    return counts.withColumn(
        "mark",
        F.when(F.col("n_records") < rarest, "rare").when(F.col("n_records") > commonest * n_papers, "common"),
    )


def updated_frequencies(observations: DataFrame, dictionary: DataFrame, aliases: DataFrame) -> DataFrame:
    """The dictionary with the number of papers that hold any of a keyword's identifiers; -1 stands for no stale count."""
    ids = aliases.select("keyword_code", F.explode(F.split("source_keyword_ids", r" \| ")).alias("keyword_id")).distinct()
    coded = observations.select("keyword_id", "row_id").join(ids, "keyword_id")
    counts = term_frequencies(coded, F.col("keyword_code"), F.col("row_id"))
    joined = dictionary.join(counts.withColumnRenamed("term", "keyword_code"), "keyword_code", "left")
    fresh = F.coalesce("n_records", F.lit(0))
    return joined.select(
        "keyword_code", "canonical_name", F.coalesce("document_frequency", F.lit(-1)).alias("stale_frequency"),
        fresh.alias("document_frequency"), (~F.col("document_frequency").eqNullSafe(fresh)).alias("changed"),
    )
