"""Wide count tables: what is split at commas, what goes through the quoted-record pattern, and that both agree with csv."""

import csv

import pytest

from strandflow.sources import sinks, text


def odd_table(folder):
    """Names with commas, doubled quotes and line breaks, also in other fields than the first, blank lines, numbers of many kinds."""
    folder.mkdir()
    want = []
    for f in range(2):
        header = ["gene", f"c{f}", 'a,"b"', "two\n\nlines", ""]
        rows = [[f"g{i}", i % 3, 0, f"{i}.5" if i % 5 else "NA", " 7 " if i % 7 == 0 else "0.0"] for i in range(60)]
        rows += [[f'q,"{i}"', i, 0, "0", 1] for i in range(20)] + [[f"l\n{i}\n\n", 0, i, 0, 0] for i in range(20)]
        rows += [["", 4, 0, 0, 0], ["kept", '0', "1", "x,1", '"2"'], ["all zero", 0, 0, 0, 0]]
        with open(folder / f"{f}.csv", "w", newline="") as out:
            csv.writer(out, lineterminator="\n").writerows([header, *rows[:50]])
            out.write("\n")
            csv.writer(out, lineterminator="\n").writerows(rows[50:])
        for gene, *values in rows:
            for cell, v in zip(header[1:], values):
                try:
                    n = float(v)
                except ValueError:
                    continue
                if n:
                    want.append((gene, cell, n))
    return sorted(want)


@pytest.mark.parametrize("at_once,split", [(1, "128m"), (200, "300"), (2 << 20, "128m")])
def test_wide_counts_agree_with_csv(spark, tmp_path, monkeypatch, at_once, split):
    """The state of quotes goes on from line to line, from batch to batch and from split to split of a file."""
    want = odd_table(tmp_path / "wide")
    monkeypatch.setattr(text, "BYTES_AT_ONCE", at_once)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted(map(tuple, text.read_wide_counts(spark, str(tmp_path / "wide")).collect()))
        records = text.read_records(spark, str(tmp_path / "wide")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got == want
    assert len(records) == 2 * 104 and {len(r.fields) for r in records} == {5} and len({r.file for r in records}) == 2


def test_only_headers_go_through_the_pattern(spark, tmp_path, monkeypatch):
    """Rows of which the first field alone is quoted are split at commas, and their zeros are never written."""
    rows = [(g, f"c{c}", 1) for g in ["plain", 'a, "b"', "g\n1"] for c in range(130) if (c + len(g)) % 9 == 0]
    counts = spark.createDataFrame(rows, "gene string, cell string, n bigint")
    sinks.write_wide_counts(counts, str(tmp_path / "wide"))
    tables, kept = {}, text.materialised
    monkeypatch.setattr(text, "materialised", lambda df, label: tables.setdefault(label, kept(df, label)))
    got = text.read_wide_counts(spark, str(tmp_path / "wide"))
    assert sorted(map(tuple, got.collect())) == sorted((g, c, float(n)) for g, c, n in rows)
    assert tables["records"].count() == len(list((tmp_path / "wide").glob("block=*/*.csv")))
