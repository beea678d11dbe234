"""Small files through Hadoop's file systems."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from tripmill import storage


def test_files(spark, tmp_path):
    folder = f"file://{tmp_path}/a/b"
    assert storage.entries(spark, folder) == [] and not storage.exists(spark, folder)
    assert storage.create(spark, f"{folder}/x", "ü1")
    assert not storage.create(spark, f"{folder}/x", "2")
    assert storage.read_text(spark, f"{folder}/x") == "ü1"
    assert storage.create(spark, f"{tmp_path}/a/c", "")
    assert storage.entries(spark, str(tmp_path / "a")) == [storage.Entry("b", storage.entries(spark, str(tmp_path / "a"))[0].size, True), storage.Entry("c", 0, False)]
    storage.remove(spark, folder)
    storage.remove(spark, folder)
    assert [e.name for e in storage.entries(spark, str(tmp_path / "a"))] == ["c"]


def test_of_many_creators_one_wins(spark, tmp_path):
    for k in range(5):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda n: storage.create(spark, f"{tmp_path}/{k}", str(n)), range(8)))
        assert sum(won) >= 1
        assert won[int(storage.read_text(spark, f"{tmp_path}/{k}"))]
    assert not [e for e in storage.entries(spark, str(tmp_path)) if e.name.startswith(".") and not e.name.endswith(".crc")]
