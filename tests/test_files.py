import hashlib
import zipfile

import pytest

from urnalake.sources import archives, files


def _zip(path, **members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for name, size in members.items():
            archive.writestr(name.replace("_dot_", "."), bytes([65]) * size)
    return path


def test_largest_csv_is_taken(spark, tmp_path):
    _zip(tmp_path / "in" / "a.zip", small_dot_csv=10, large_dot_csv=5000, medium_dot_csv=100)
    _zip(tmp_path / "in" / "b.zip", data_dot_txt=9000, UPPER_dot_CSV=8000, only_dot_csv=3)
    found = files.list_files(spark, str(tmp_path / "in"), "*.zip")
    landed = archives.land_archives(spark, found, str(tmp_path / "out")).collect()
    by_member = {r["member"]: r for r in landed}
    assert set(by_member) == {"large.csv", "only.csv"}
    for name, size in (("large.csv", 5000), ("only.csv", 3)):
        content = bytes([65]) * size
        with open(by_member[name]["csv_path"].removeprefix("file:"), "rb") as f:
            assert f.read() == content
        assert by_member[name]["size_bytes"] == size
        assert by_member[name]["sha256"] == hashlib.sha256(content).hexdigest()


def test_equal_sizes_take_the_first_in_archive_order(spark, tmp_path):
    _zip(tmp_path / "in" / "a.zip", zz_dot_csv=10, aa_dot_csv=10)
    found = files.list_files(spark, str(tmp_path / "in"))
    assert archives.largest_csv(archives.members(found)).first()["member"] == "zz.csv"


def test_archive_without_csv_fails(spark, tmp_path):
    _zip(tmp_path / "in" / "a.zip", data_dot_txt=10)
    found = files.list_files(spark, str(tmp_path / "in"))
    with pytest.raises(archives.NoCsvInArchive, match="a.zip"):
        archives.land_archives(spark, found, str(tmp_path / "out"))


def test_members_in_folders_stay_below_the_landing_folder(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("../../evil.csv", "x")
    found = files.list_files(spark, str(tmp_path), "*.zip")
    row = archives.land_archives(spark, found, str(tmp_path / "out")).first()
    assert row["csv_path"].startswith(f"file:{tmp_path / 'out'}")
    assert not (tmp_path.parent / "evil.csv").exists()


def test_landing_again_replaces_the_file(spark, tmp_path):
    path = _zip(tmp_path / "in" / "a.zip", a_dot_csv=10)
    found = files.list_files(spark, str(tmp_path / "in"))
    archives.land_archives(spark, found, str(tmp_path / "out"))
    _zip(path, a_dot_csv=20)
    assert archives.land_archives(spark, found, str(tmp_path / "out")).first()["size_bytes"] == 20


def test_digests_equal_hashlib(spark, tmp_path):
    contents = {"a.csv": b"test content\n", "b b.csv": b"x" * (3 << 20)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    got = {r["path"].rsplit("/", 1)[-1]: r for r in files.digests(files.list_files(spark, str(tmp_path))).collect()}
    for name, content in contents.items():
        assert got[name]["sha256"] == hashlib.sha256(content).hexdigest()
        assert got[name]["size_bytes"] == len(content)


def test_folder_digest(spark, tmp_path):
    def digest(**contents):
        folder = tmp_path / hashlib.sha256(repr(contents).encode()).hexdigest()[:8]
        folder.mkdir()
        for name, content in contents.items():
            (folder / f"{name}.csv").write_bytes(content)
        return files.folder_digest(files.digests(files.list_files(spark, str(folder)))).first()

    one = digest(a=b"one")
    assert one == (1, 3, hashlib.sha256(b"one").hexdigest())
    both, renamed, changed = digest(a=b"one", b=b"two"), digest(x=b"two", y=b"one"), digest(a=b"one", b=b"twO")
    assert both == renamed and both["n_files"] == 2 and both["size_bytes"] == 6
    assert both["sha256"] != changed["sha256"]


def test_folder_digest_counts_equal_files(spark, tmp_path):
    def digest(name, *contents):
        folder = tmp_path / name
        folder.mkdir()
        for i, content in enumerate(contents):
            (folder / f"{i}.csv").write_bytes(content)
        return files.folder_digest(files.digests(files.list_files(spark, str(folder)))).first()["sha256"]

    assert len({digest("a", b"one", b"one"), digest("b", b"two", b"two"), digest("c", b"one", b"two")}) == 3


def test_paths_without_a_filesystem_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="names no filesystem"):
        files.open_filesystem("/lake/landing")
    assert files.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
    assert files.open_filesystem(f"file://{tmp_path}")[1] == files.open_filesystem(f"file:{tmp_path}")[1] == str(tmp_path)


def _tree(content, range_bytes, fanout):
    level = [hashlib.sha256(content[i : i + range_bytes]).hexdigest() for i in range(0, max(len(content), 1), range_bytes)]
    while True:
        level = [hashlib.sha256("".join(level[i : i + fanout]).encode()).hexdigest() for i in range(0, len(level), fanout)]
        if len(level) == 1:
            return level[0]


@pytest.mark.parametrize(("range_bytes", "fanout"), [(100, 2), (64, 3), (5000, 4), (1 << 20, 1024)])
def test_digest_tree_equals_the_definition(spark, tmp_path, range_bytes, fanout):
    contents = {"a b%20.csv": bytes(range(256)) * 9, "empty.csv": b"", "one.csv": b"x", "even.csv": b"y" * 200}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    assert {r["path"].rsplit("/", 1)[1]: r["length"] for r in listed.collect()} == {n: len(c) for n, c in contents.items()}
    expected = {n: _tree(c, range_bytes, fanout) for n, c in contents.items()}
    for parts in (1, 7):  # however tasks share the work
        leaves = files.range_digests(listed.repartition(parts), range_bytes)
        got = {r["path"].rsplit("/", 1)[1]: r["sha256"] for r in files.tree_digests(leaves, fanout).collect()}
        assert got == expected


def test_empty_files_are_digested(spark, tmp_path):
    (tmp_path / "empty.csv").write_bytes(b"")
    (tmp_path / "full.csv").write_bytes(b"abc")
    found = files.digests(files.list_files(spark, str(tmp_path))).collect()
    assert {r["size_bytes"]: r["sha256"] for r in found} == {0: hashlib.sha256(b"").hexdigest(), 3: hashlib.sha256(b"abc").hexdigest()}
    assert files.folder_digest(files.digests(files.list_files(spark, str(tmp_path)))).first()["n_files"] == 2
