"""Slices of files that hold many pages."""

import random

import pyarrow as pa
import pyarrow.parquet as pq

from ledgerline.sources import paged


def test_a_slice_is_read_once_and_in_pieces(tmp_path, monkeypatch):
    """Rows in any order, of two files, equal keys and ids among them and some without an id: each page of a slice was a scan of it, and equal ids at its end were lost."""
    rng = random.Random(1)
    rows = [(rng.randrange(50), None if i % 97 == 5 else rng.randrange(200), f"v{i}") for i in range(6000)] + [(None, i, "none") for i in range(300)]
    (tmp_path / "rows").mkdir()
    for n in range(2):
        part = rows[n::2]
        table = pa.table({"at": pa.array([r[0] for r in part], pa.int64()), "id": pa.array([r[1] for r in part], pa.int64()), "v": [r[2] for r in part]})
        pq.write_table(table, tmp_path / "rows" / f"{n}.parquet", row_group_size=1000)
    options = {"path": str(tmp_path / "rows"), "key": "at", "id": "id", "slices": "3", "pagesize": "40"}
    monkeypatch.setattr(paged, "RUN", 4096, raising=False)
    monkeypatch.setattr(paged, "BATCH", 1024, raising=False)
    read, real = [], pq.ParquetFile.iter_batches
    monkeypatch.setattr(pq.ParquetFile, "iter_batches", lambda self, *a, **k: read.append(1) or real(self, *a, **k))
    reader = paged.PagedReader(options, paged.FilePages(options).schema())
    found, parts = [], reader.partitions()
    for part in parts:
        pages = [p for p in reader.read(part)]
        got = [tuple(r.values()) for p in pages for r in p.to_pylist()]
        assert all(p.num_rows == 40 for p in pages[:-1]) and pages[-1].num_rows <= 40
        assert [r[:2] for r in got] == sorted((r[:2] for r in got), key=lambda r: (r[0] or 0, r[1] is None, r[1] or 0))
        found += got
    assert sorted(map(str, found)) == sorted(map(str, rows))
    assert len(parts) == 4 and len(read) == 8  # each file once for each slice and for the rows without a key
