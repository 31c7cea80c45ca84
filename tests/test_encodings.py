import io
import random

import pytest
from helpers import HEADER, write_text

from urnalake import schema as S
from urnalake.operators import audit
from urnalake.plans import Lake, ingest
from urnalake.sources import audit_log, encodings, files, landed_csv

LINE = "2022;12345;São Paulo;SP;1000;800;200"


def valid(data):
    try:
        data.decode("utf-8")
    except UnicodeDecodeError:
        return False
    return True


def test_ranges_of_any_size_tell_what_the_whole_file_tells():
    draws = random.Random(5)
    texts = ["", "a", "é", "€", "😀", "aé€😀", "\x00\x7f", "São João"]
    samples = [t.encode() for t in texts] + [t.encode()[:-1] for t in texts] + [t.encode()[1:] for t in texts]
    samples += [b"\x80" * n for n in range(1, 6)] + [b"a" + b"\x80" * n for n in range(1, 6)]
    samples += [b"\xc0\xaf", b"\xed\xa0\x80", b"\xf4\x90\x80\x80", b"\xff", "São".encode("latin-1")]
    pieces = [b"a", b"\xc3", b"\xa9", b"\xe2\x82", b"\xac", b"\xf0\x9f", b"\x98\x80", "é€😀".encode()]
    samples += [b"".join(draws.choices(pieces, k=draws.randint(1, 8))) for _ in range(3000)]
    for data in samples:
        for size in range(1, 8):
            starts = range(0, max(len(data), 1), size)
            found = all([encodings.is_utf8(io.BytesIO(data), at, min(at + size, len(data))) for at in starts])
            assert found == valid(data), (data, size)


@pytest.mark.parametrize("range_bytes", [1, 3, 7, 1 << 20])
def test_files_are_judged_one_by_one(spark, tmp_path, range_bytes):
    write_text(tmp_path / "utf8.csv", HEADER, LINE)
    write_text(tmp_path / "deep" / "latin[1].csv", HEADER, LINE, encoding="latin-1")
    write_text(tmp_path / "ascii.csv", HEADER)
    (tmp_path / "empty.csv").touch()
    listed = files.list_files(spark, str(tmp_path))
    found = {r["path"].rsplit("/", 1)[1]: r["encoding"] for r in encodings.file_encodings(listed, range_bytes).collect()}
    assert found == {"utf8.csv": "UTF-8", "latin[1].csv": "ISO-8859-1", "ascii.csv": "UTF-8", "empty.csv": "UTF-8"}


@pytest.mark.parametrize(("multi_line", "name"), [(False, "c[1].csv"), (True, "c.csv")])
def test_a_mixed_folder_is_read_exactly(spark, tmp_path, multi_line, name):
    write_text(tmp_path / "a.csv", HEADER, LINE)
    write_text(tmp_path / "b" / name, HEADER, LINE, LINE.replace("São", "Mação").rsplit(";", 1)[0], encoding="latin-1")
    lines = landed_csv.read_landed(spark, str(tmp_path), encodings.PER_FILE, multi_line=multi_line)
    assert sorted(r["NM_MUNICIPIO"] for r in lines.collect()) == ["Mação Paulo", "São Paulo", "São Paulo"]


def test_headers_and_kinds_of_files(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        (tmp_path / "empty").mkdir()
        (tmp_path / "empty" / "a.csv").touch()
        landed_csv.read_landed(spark, str(tmp_path / "empty"), encodings.PER_FILE)
    write_text(tmp_path / "two" / "a.csv", HEADER, LINE)
    write_text(tmp_path / "two" / "b.csv", HEADER.replace("SG_UF", "UF"), LINE, encoding="latin-1")
    with pytest.raises(ValueError, match="header differs"):
        landed_csv.read_landed(spark, str(tmp_path / "two"), encodings.PER_FILE)
    (tmp_path / "three").mkdir()
    (tmp_path / "three" / "a.csv.gz").write_bytes(b"\x1f\x8b")
    with pytest.raises(ValueError, match="compressed"):
        landed_csv.read_landed(spark, str(tmp_path / "three"), encodings.PER_FILE)


def test_the_load_records_its_encodings(spark, tmp_path):
    write_text(tmp_path / "in" / "a.csv", HEADER, LINE)
    write_text(tmp_path / "in" / "b.csv", HEADER, LINE, encoding="latin-1")
    write_text(tmp_path / "in" / "c.csv", HEADER, LINE.replace("São", "Sao"))
    lake = Lake(str(tmp_path / "lake"))
    assert ingest(spark, lake, {2022: str(tmp_path / "in")}, encoding=encodings.PER_FILE) == [2022]
    names = [r["NM_MUNICIPIO"] for r in spark.read.parquet(lake.bronze).collect()]
    assert sorted(names) == ["Sao Paulo", "São Paulo", "São Paulo"]
    log = audit.latest(audit_log.read_log(spark, lake.bronze_log, S.BRONZE_AUDIT_SCHEMA)).first()
    assert (log["codificacao"], log["linhas"]) == ("ISO-8859-1:1,UTF-8:2", 3)
