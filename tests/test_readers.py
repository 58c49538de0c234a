import os

import pytest

from transit_prices.sources import readers


def test_read_csv_fail_soft_and_folder(spark, tmpdir_path):
    cols = ["numero", "nom_voie", "code_postal", "nom_commune", "lon", "lat"]
    folder = os.path.join(tmpdir_path, "ban")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write(";".join(cols) + "\n1;RUE A;75001;PARIS;2.3;48.8\n1;RUE A;75001;PARIS;2.31;48.81\n")
    with open(os.path.join(folder, "b.csv"), "w") as f:
        f.write(";".join(cols) + "\n2;Rue Évry;91000;EVRY;2.4;48.6\n")
    with open(os.path.join(folder, "notes.txt"), "w") as f:
        f.write("not a table\n")
    df = readers.read_csv_folder(spark, folder, cols)
    assert df.count() == 3 and df.columns == cols
    empty = readers.read_csv(spark, os.path.join(tmpdir_path, "missing.csv"), cols, sep=";", on_error="empty")
    assert empty.count() == 0 and empty.columns == cols
    with pytest.raises(Exception):
        readers.read_csv(spark, os.path.join(tmpdir_path, "missing.csv"), cols, sep=";").count()


def test_rename_and_require(spark):
    df = spark.createDataFrame([("x", 1)], "`Date mutation` string, `Other Col` int")
    out = readers.rename_columns(df, readers.SALES_HEADERS)
    assert out.columns == ["date_mutation", "other col"]
    with pytest.raises(KeyError):
        readers.require_columns(out, ["date_mutation", "prix_m2"])


def test_folder_with_differing_headers(spark, tmpdir_path):
    cols = ["numero", "nom_voie", "lon"]
    files = {
        "a.csv": "numero;nom_voie;lon\n1;RUE A;2.3\n", "b.csv": "id;lon;numero;nom_voie;extra\nx;2.4;2;RUE B;y\n",
        "sub/c.csv": "numero;nom_voie\n3;RUE C\n", "d.csv": "", "e.csv": "numero;nom_voie;lon\n", "f.txt": "numero\n9\n",
    }
    for name, text in files.items():
        path = os.path.join(tmpdir_path, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    got = sorted(tuple(r) for r in readers.read_csv_folder(spark, tmpdir_path, cols).collect())
    assert got == [("1", "RUE A", "2.3"), ("2", "RUE B", "2.4"), ("3", "RUE C", None)]
    listed = {os.path.basename(r["path"]): r["status"] for r in readers.csv_files(spark, tmpdir_path).collect()}
    assert listed == {"a.csv": "ok", "b.csv": "ok", "c.csv": "ok", "e.csv": "ok"}  # no bytes, nothing to list


def test_header_discovery_jobs_do_not_grow_with_files(spark, tmpdir_path):
    def jobs(folder, tag):
        spark.sparkContext.setJobGroup(tag, tag)
        rows = readers.csv_files(spark, folder).collect()
        ids = spark.sparkContext.statusTracker().getJobIdsForGroup(tag)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(ids), rows

    found = []
    for n in (2, 25):
        folder = os.path.join(tmpdir_path, f"n{n}")
        os.makedirs(folder)
        for i in range(n):
            with open(os.path.join(folder, f"part {i} é%.csv"), "wb") as f:  # names that a URI would escape
                f.write("\ufeff\"a;b\";c;c\r\n".encode() + b"x;y;z\r\n" * 50_000)
        found.append(jobs(folder, f"headers-{n}"))
        assert len(found[-1][1]) == n and all(r["header"] == ["a;b", "c", "c"] and r["status"] == "ok" for r in found[-1][1])
    assert found[0][0] == found[1][0] <= 3
    got = readers.read_csv_folder(spark, os.path.join(tmpdir_path, "n2"), ["c", "a;b", "none"])
    assert got.count() == 100_000 and tuple(got.first()) == ("y", "x", None)


def test_unreadable_and_blank_files_are_reported(spark, tmpdir_path):
    for name, text in {"good.csv": "a;b\n1;2\n", "blank.csv": "\n1;2\n", "bad.csv": "a;b\n3;4\n", "one.csv": "a;b"}.items():
        with open(os.path.join(tmpdir_path, name), "w") as f:
            f.write(text)
    with open(os.path.join(tmpdir_path, ".bad.csv.crc"), "wb") as f:  # a checksum that does not fit: reading fails
        f.write(b"crc\0" + (512).to_bytes(4, "big") + b"\0\0\0\1")
    files = readers.csv_files(spark, tmpdir_path)
    status = {os.path.basename(r["path"]): r["status"] for r in files.collect()}
    assert status == {"good.csv": "ok", "one.csv": "ok", "blank.csv": "empty", "bad.csv": "unreadable"}
    assert [tuple(r) for r in readers.read_csv_folder(spark, tmpdir_path, ["b"], files=files).collect()] == [("2",)]


def test_prepared_table_drops_the_index_column(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "prepared")
    spark.createDataFrame([(0, "x", 1.5)], "`Unnamed: 0` int, a string, b double").write.parquet(path)
    assert readers.read_prepared(spark, path).columns == ["a", "b"]
