"""Runs of homozygosity: interrupted-run form and two-state model form."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.genotype import is_het
from ..functions.text import pack_tags
from .ordered import BUCKET, scan

WINDOW_BASES = 1 << 20
# State change rates per base and recombination rate (100 cM/Mb).
HW_TO_AZ = 6.7e-8
AZ_TO_HW = 5e-9
REC_RATE = 1e-6


def homozygous_runs(geno: DataFrame) -> DataFrame:
    """Stretches of calls between heterozygous calls, per sample and chromosome.

    The running count of heterozygous calls is taken per genome window and
    carried over, so no chromosome is sorted in one task.
    """
    marked = geno.withColumns(
        {BUCKET: F.floor(F.col("pos") / WINDOW_BASES), "_het": is_het().cast("bigint")}
    )
    islands = scan(marked, ["sample", "chrom"], ["pos"], {"island": ("sum", "_het")})
    return (
        islands.where(F.col("_het") == 0)
        .groupBy("sample", "chrom", "island")
        .agg(
            F.min("pos").alias("start"),
            F.max("pos").alias("end"),
            (F.max("pos") - F.min("pos") + 1).alias("length"),
            F.count(F.lit(1)).alias("n_markers"),
            F.avg(F.coalesce(F.col("gq"), F.lit(0))).alias("quality"),
        )
        .drop("island")
    )


def long_regions(regions: DataFrame, min_length: int = 5000) -> DataFrame:
    """Regions strictly longer than the threshold."""
    return regions.where(F.col("length") > min_length)


def bed_rows(regions: DataFrame) -> DataFrame:
    """Four BED columns with the attributes packed in the last one."""
    return regions.select(
        "chrom",
        "start",
        "end",
        pack_tags(
            Length=F.col("length"), NumberOfMarkers=F.col("n_markers"), Quality=F.col("quality")
        ).alias("attributes"),
    )


def _log_emissions(af: np.ndarray, dose: np.ndarray, error: float) -> np.ndarray:
    """Log likelihood of each dosage in the outbred (0) and autozygous (1) state."""
    af = np.clip(af, 1e-3, 1 - 1e-3)
    out = np.stack([(1 - af) ** 2, 2 * af * (1 - af), af**2])
    az = np.stack([1 - af, np.full_like(af, error), af])
    rows = np.arange(len(dose))
    both = np.stack([out[dose, rows], az[dose, rows]], axis=1)
    return np.log(both * (1 - error) + error / 3)


def _log_moves(gaps: np.ndarray, morgans: np.ndarray | None = None) -> np.ndarray:
    """Log change matrix per marker: [marker, from, to], by distance to the one before, in bases and on the map."""
    reach = 1 - np.exp(-(gaps * REC_RATE if morgans is None else morgans))
    to_az = np.clip(HW_TO_AZ * np.maximum(gaps, 1), 1e-12, 0.5) + 1e-4 * reach
    to_hw = np.clip(AZ_TO_HW * np.maximum(gaps, 1), 1e-12, 0.5) + 1e-4 * reach
    moves = np.empty((len(gaps), 2, 2))
    moves[:, 0, 0], moves[:, 0, 1] = 1 - to_az, to_az
    moves[:, 1, 0], moves[:, 1, 1] = to_hw, 1 - to_hw
    return np.log(moves)


def _best_paths(steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best score and predecessors from either entry state through all steps."""
    s00, s01, s10, s11 = 0.0, -math.inf, -math.inf, 0.0
    back = []
    # plain numbers: one marker is too little for an array operation. The first state wins a tie
    for t00, t01, t10, t11 in steps.reshape(-1, 4).tolist():
        a0, a1, b0, b1 = s00 + t00, s01 + t10, s00 + t01, s01 + t11
        c0, c1, d0, d1 = s10 + t00, s11 + t10, s10 + t01, s11 + t11
        back.append((a1 > a0, b1 > b0, c1 > c0, d1 > d0))
        s00, s01 = a1 if a1 > a0 else a0, b1 if b1 > b0 else b0
        s10, s11 = c1 if c1 > c0 else c0, d1 if d1 > d0 else d0
    return np.array([[s00, s01], [s10, s11]]), np.array(back, dtype=np.int8).reshape(-1, 2, 2)


def autozygous_runs(geno: DataFrame, error: float = 1e-3) -> DataFrame:
    """Most likely autozygous regions of the two-state model, per sample and chromosome.

    Best paths compose like matrix products, so each genome window is solved
    from both entry states on its own (window, not chromosome, is the unit of
    work); the windows of a chromosome are then chained, at most a few hundred
    small rows, and each window is traced back from its known end state.
    geno: sample, chrom, pos, dosage (0/1/2), af, and cm where there is a genetic map
    (see `genetic_map`): markers then recombine by their distance on it. Without the column, or
    where it is null, the rate per base is the same everywhere.
    """
    chunk = ["sample", "chrom", BUCKET]
    marked = geno.where(F.col("dosage") >= 0).withColumn(BUCKET, F.floor(F.col("pos") / WINDOW_BASES))
    if "cm" not in geno.columns:
        marked = marked.withColumn("cm", F.lit(None).cast("double"))
    marked = marked.withColumn("cm", F.coalesce("cm", F.col("pos") * (100 * REC_RATE)).cast("double"))
    bounds = marked.groupBy(*chunk).agg(F.max("pos").alias("last_pos"), F.max("cm").alias("last_cm"))
    order = Window.partitionBy("sample", "chrom").orderBy(BUCKET)
    entries = bounds.withColumns(
        {"prev_pos": F.lag("last_pos").over(order), "prev_cm": F.lag("last_cm").over(order)}
    ).drop("last_pos", "last_cm")
    linked = marked.join(entries, chunk)

    def steps_of(pdf: pd.DataFrame) -> np.ndarray:
        pos = pdf["pos"].to_numpy(dtype="float64")
        prev = pdf["prev_pos"].iloc[0]
        gaps = np.diff(pos, prepend=pos[0] if pd.isna(prev) else prev)
        cm, prev_cm = pdf["cm"].to_numpy(dtype="float64"), pdf["prev_cm"].iloc[0]
        morgans = np.maximum(np.diff(cm, prepend=cm[0] if pd.isna(prev_cm) else prev_cm), 0) / 100
        emit = _log_emissions(pdf["af"].to_numpy(dtype="float64"), pdf["dosage"].to_numpy(), error)
        return _log_moves(gaps, morgans) + emit[:, None, :]

    def summarize(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        score, _ = _best_paths(steps_of(pdf))
        first = pdf.iloc[0]
        return pd.DataFrame(
            [[first["sample"], first["chrom"], first[BUCKET], score.ravel().tolist()]],
            columns=[*chunk, "score"],
        )

    key_types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in linked.select(*chunk).schema.fields)
    summaries = linked.groupBy(*chunk).applyInPandas(summarize, f"{key_types}, score array<double>")

    def chain(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(BUCKET).reset_index(drop=True)
        paths = np.stack([np.asarray(s).reshape(2, 2) for s in pdf["score"]])
        start, entered = np.array([0.0, 0.0]), []
        for p in paths:
            entered.append(start)
            start = (start[:, None] + p).max(axis=0)
        state, ends, starts = int(start.argmax()), [], []
        for p, before in zip(paths[::-1], entered[::-1]):
            ends.append(state)
            state = int((before + p[:, state]).argmax())
            starts.append(state)
        return pdf[chunk].assign(entry=starts[::-1], exit=ends[::-1])

    states = summaries.groupBy("sample", "chrom").applyInPandas(
        chain, f"{key_types}, entry int, exit int"
    )

    def trace(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos").reset_index(drop=True)
        _, back = _best_paths(steps_of(pdf))
        entry, state = int(pdf["entry"].iloc[0]), int(pdf["exit"].iloc[0])
        path = []
        for step in back[::-1, entry].tolist():
            path.append(state)
            state = step[state]
        path = np.array(path[::-1], dtype="int64")
        return pdf[["sample", "chrom", "pos", BUCKET]].assign(az=path)

    traced = linked.join(states, chunk).groupBy(*chunk).applyInPandas(
        trace, _trace_schema(linked)
    )
    breaks = traced.withColumn("_out", 1 - F.col("az"))
    islands = scan(breaks, ["sample", "chrom"], ["pos"], {"island": ("sum", "_out")})
    return (
        islands.where(F.col("az") == 1)
        .groupBy("sample", "chrom", "island")
        .agg(
            F.min("pos").alias("start"),
            F.max("pos").alias("end"),
            (F.max("pos") - F.min("pos") + 1).alias("length"),
            F.count(F.lit(1)).alias("n_markers"),
        )
        .drop("island")
    )


def _trace_schema(linked: DataFrame) -> str:
    names = ["sample", "chrom", "pos", BUCKET]
    return ", ".join(f"{n} {linked.schema[n].dataType.simpleString()}" for n in names) + ", az bigint"
