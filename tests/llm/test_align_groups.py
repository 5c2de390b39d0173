"""The slices of op12 lie in row groups of a bounded size."""

from pathlib import Path

import pyarrow.parquet as pq

from churnframe.llm import align


def test_slices_are_written_in_small_row_groups(spark, monkeypatch):
    # a reader holds a row group of each column at once
    monkeypatch.setattr(align, "GROUP_BYTES", 1 << 16, raising=False)
    kept = []
    plain = align.materialize_as

    def written(df, name, *more):
        out = plain(df, name, *more)
        kept.append((name, out._scratch_path))
        return out
    monkeypatch.setattr(align, "materialize_as", written)
    rows = [(i, " ".join(f"word{(i * 7 + k * k) % 997}" for k in range(3000))) for i in range(24)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = align.align_tokenizers(df, slice_bytes=30_000)
    path = dict(kept)["aligned-slices"].removeprefix("file:")
    n = [m.row_group(i).num_rows for f in Path(path).glob("*.parquet")
         for m in [pq.ParquetFile(f).metadata] for i in range(m.num_row_groups)]
    assert sum(n) == 24 and max(n) <= 2, n
    assert out.filter("n_links > 0").count() == 24
