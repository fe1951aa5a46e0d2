"""Content checksums: no task reads more of a file than one block."""

import hashlib
import random

from harmonia.sources import files
from harmonia.sources.files import manifest


def test_large_files_are_summed_by_blocks_and_others_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WHOLE", 1000, raising=False)
    r = random.Random(5)
    data = {"a b+c.csv": 1000, "big.parquet": 1001, "bigger.csv": 9000, "empty.json": 0, "left.txt": 5000}
    data = {name: bytes(r.randrange(256) for _ in range(n)) for name, n in data.items()}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    blocks = {m["filename"]: m["checksum"] for m in manifest(spark, str(tmp_path), checksum_mode="blocks").collect()}
    old, found = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for size in (500, 1 << 27):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            df = manifest(spark, str(tmp_path), checksum_mode="content")
            assert df.columns == ["path", "filename", "stem", "ext", "length", "modified", "checksum"]
            found.append({m["filename"]: (m["length"], m["checksum"]) for m in df.collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert found[0] == found[1] == {name: (len(c), hashlib.sha256(c).hexdigest() if len(c) <= 1000 else blocks[name])
                                    for name, c in data.items() if name != "left.txt" and (len(c) or name in found[0])}
    (tmp_path / "bigger.csv").write_bytes(data["bigger.csv"][:-1] + b"\n")
    after = {m["filename"]: m["checksum"] for m in manifest(spark, str(tmp_path), checksum_mode="content").collect()}
    assert {n for n, c in after.items() if c != found[0][n][1]} == {"bigger.csv"}
