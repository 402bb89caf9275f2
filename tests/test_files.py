"""Tile files that are taken or rejected as a whole, and files of different encodings."""

import os

from wayflux import schema
from wayflux.sources import files

COLS = [c.strip().split(" ")[0] for c in schema.MOVEMENT_TILES.split(",")]
TYPES = dict(c.strip().split(" ") for c in schema.MOVEMENT_TILES.split(","))


def row(k, **changes):
    value = {c: "1" if t != "STRING" else f"s{k}" for c, t in TYPES.items()}
    value |= {"geometry": '"LINESTRING (-75.5 4.5, -75.25 4.25)"', "date_time": "2020-05-01 0800", **changes}
    return ",".join(value[c] for c in COLS)


def test_one_bad_row_removes_its_file(spark, tmp_path):
    number = next(c for c, t in TYPES.items() if t == "DOUBLE")
    texts = {
        "good": [",".join(COLS), row(1), row(2), "", row(3, **{number: ""})],
        "turned": [",".join(COLS[::-1]), ",".join(['"LINESTRING (-75.5 4.5, -75.25 4.25)"' if c == "geometry" else "2020-05-02 0000" if c == "date_time" else "2" for c in COLS[::-1]])],
        "letter": [",".join(COLS), row(4), row(5, **{number: "x"}), row(6, date_time="soon")],
        "short": [",".join(COLS), row(7), row(8).rsplit(",", 1)[0]],
        "long": [",".join(COLS), row(9) + ",9"],
        "other": [",".join(COLS[:-1]), row(10).rsplit(",", 1)[0]],
        "headless": [row(11)],
    }
    for name, lines in texts.items():
        (tmp_path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    ok, rejected = files.checked_tiles(spark, str(tmp_path))
    got = {(os.path.basename(r.file), r.reason, r.bad_rows) for r in rejected.collect()}
    assert got == {("letter.csv", "rows", 2), ("short.csv", "rows", 1), ("long.csv", "rows", 1), ("other.csv", "columns", 1), ("headless.csv", "columns", 1)}
    assert ok.count() == 4 and {str(r[0]) for r in ok.select("date_time").collect()} == {"2020-05-01 08:00:00", "2020-05-02 00:00:00"}
    assert {(r[0], r[1]) for r in ok.select("start_movement_lon", "end_movement_lat").collect()} == {(-75.5, 4.25)}
    assert files.ingest_tiles(spark, str(tmp_path), "2020-05-02").count() == 3
    assert files.ingest_tiles(spark, str(tmp_path), drop_null=True).count() == 3


def test_each_file_has_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("id,name\n1,Bogotá\n2,plain\n".encode())
    (tmp_path / "b.csv").write_bytes("id,name\n3,Bogotá\n4,plain\n5,Córdoba\n".encode("latin-1"))
    got = {(r.id, r.name) for r in files.decoded_csv(spark, str(tmp_path), "id INT, name STRING").collect()}
    assert got == {(1, "Bogotá"), (2, "plain"), (3, "Bogotá"), (4, "plain"), (5, "Córdoba")}
