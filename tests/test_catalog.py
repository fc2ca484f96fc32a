import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from granulake.operators.catalog import (
    existing_paths,
    location_patterns,
    match_locations,
    new_tracking_rows,
    unseen_files,
)
from granulake.operators.mapping import mapped_columns, mapped_header_line, records, with_csv_line
from granulake.operators.tracking import (
    apply_updates,
    claim,
    claim_rows,
    changed_rows,
    claimed_updates,
    done_updates,
)
from granulake.plans.jobs import export, extract_lines, located_headers, process, walk
from granulake.schemas import TRACKING_SCHEMA
from granulake.sinks.tracking_table import TrackingStore
from granulake.sources.granules import (
    decode_headers,
    granule_files,
    named_headers,
    read_header_store,
    stored_path,
    write_header_store,
)
from granulake.sources.mapping_config import load_mapping

T0 = datetime(2020, 1, 1)
LISTED = "path string, mtime timestamp_ntz"
CONFIG = {
    "rad": {
        "metadata": {"scene_id": "scene"},
        "data": {"px": "pixels", "box": {"west": "west", "none": "absent"}},
    },
    "mcm": {"data": {"px": "pixels"}},
}


def tracked(spark, *rows):
    """Rows of (project, path, data, day, file_type, inqueue)."""
    return spark.createDataFrame(
        [
            (p, path.rsplit("/", 1)[-1], path, data, datetime(2020, 1, day), kind, state)
            for p, path, data, day, kind, state in rows
        ],
        TRACKING_SCHEMA,
    )


def header(scene="s", px=1, west=2.5):
    return json.dumps(
        {
            "attributes": {"scene_id": scene},
            "variables": {"px": {"data": px}, "box": {"attributes": {"west": west}}},
        }
    )


def state(df):
    return {(r.project, r.path): (r.data, r.inqueue) for r in df.collect()}


# --- listing ----------------------------------------------------------------
def test_first_location_types_a_file_and_repeats_count_once(spark):
    listing = spark.createDataFrame(
        [("/s/a/1.nc", T0), ("/s/a/1.nc", datetime(2021, 1, 1)), ("/s/b/2.nc", T0), ("/t/3.nc", T0)],
        LISTED,
    )
    files = match_locations(listing, "/s", ["a/*.nc", "*/*.nc"], ["first", "second"])
    assert {(r.path, r.file_type, r.mtime.year) for r in files.collect()} == {
        ("/s/a/1.nc", "first", 2021),
        ("/s/b/2.nc", "second", 2020),
    }


def test_unequal_lists_are_refused_and_none_match_nothing(spark):
    listing = spark.createDataFrame([("/s/a.nc", T0)], LISTED)
    with pytest.raises(ValueError, match="file types"):
        match_locations(listing, "/s", ["a", "b"], ["one"])
    assert match_locations(listing, "/s", [], []).count() == 0


def test_unseen_ignores_type_and_other_projects(spark):
    listing = spark.createDataFrame(
        [("/s/a.nc", T0), ("/s/b.nc", T0), ("/s/c.nc", T0), ("/s/c.nc", T0)], LISTED
    )
    table = tracked(spark, ("P", "/s/a.nc", "", 1, "other", 0), ("Q", "/s/b.nc", "", 1, "x", 1))
    typed = match_locations(listing, "/s", ["*.nc"], ["x"])
    unseen = unseen_files(typed, table, "P")
    assert sorted(r.path for r in unseen.collect()) == ["/s/b.nc", "/s/c.nc"]
    rows = new_tracking_rows(unseen, "P").collect()
    assert {tuple(r)[:4] + tuple(r)[5:] for r in rows} == {
        ("P", "b.nc", "/s/b.nc", "", "x", 1),
        ("P", "c.nc", "/s/c.nc", "", "x", 1),
    }
    assert [r.path for r in existing_paths(table, listing, "P").collect()] == ["/s/a.nc"]


def test_stored_files_and_decoder(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.nc").write_bytes(b"one")
    files = granule_files(spark, [f"{tmp_path}/*/*.nc", f"{tmp_path}/none/*.nc"])
    row = files.first()
    assert row.path == f"{tmp_path}/a/one.nc" and row["size"] == 3
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert granule_files(spark, [f"{tmp_path}/none/*.nc"]).count() == 0
    decoded = decode_headers(
        granule_files(spark, [f"{tmp_path}/*/*.nc"], content=True), lambda data: data.decode()
    )
    assert [tuple(r) for r in decoded.collect()] == [(f"{tmp_path}/a/one.nc", "one")]


def test_listing_with_a_scheme_an_absolute_location_and_no_file_in_the_plan(spark, tmp_path):
    for day in ("1", "2"):
        (tmp_path / "s" / day).mkdir(parents=True)
        for name in ("a.nc", "b.nc", "d.nc", "c.txt"):
            (tmp_path / "s" / day / name).write_bytes(b"x")
    (tmp_path / "s" / "file.nc").write_bytes(b"x")
    listed = {f"{tmp_path}/s/{day}/{name}.nc" for day in "12" for name in "abd"}
    for root in (f"{tmp_path}/s", f"file://{tmp_path}/s/"):
        patterns = [stored_path(spark, p) for p in location_patterns(root, ["*/*.nc"])]
        files = granule_files(spark, patterns)
        # two folders, and the file beside them
        assert "(3 paths)" in files._jdf.queryExecution().executedPlan().toString()
        found = match_locations(files, root, patterns, ["x"])
        assert {r.path for r in files.collect()} == {r.path for r in found.collect()} == listed
    assert location_patterns("/r", ["a", "/b", "file:/c"]) == ["/r/a", "/b", "file:/c"]
    elsewhere = location_patterns("/none", [f"{tmp_path}/s/1/*.nc"])
    found = match_locations(granule_files(spark, elsewhere), "/none", elsewhere, ["x"])
    assert found.count() == 3


def test_lines_from_the_header_store_use_the_latest_and_prune_days(spark, tmp_path):
    folder = str(tmp_path)
    for px in (1, 2):
        rows = [(f"/s/p/2020/{d}/g.nc", header(px=px)) for d in (1, 2)] + [("/other/g.nc", header())]
        found = named_headers(spark.createDataFrame(rows, "path string, header string"), "/s/")
        write_header_store(found, folder)
    stored = read_header_store(spark, folder)
    assert {r.name for r in stored.collect()} == {"p/2020/1/g.nc", "p/2020/2/g.nc"}
    claimed = spark.createDataFrame(
        [("g.nc", "/s/p/2020/1/g.nc", T0, "mcm")], "filename string, path string, mtime timestamp_ntz, file_type string"
    )
    lines = extract_lines(claimed, stored, CONFIG, "/s", "/s")
    assert [r.csv_line for r in lines.collect()] == ["gs://p/2020/1/g.nc,2"]
    assert "dynamicpruning" in lines._jdf.queryExecution().executedPlan().toString()


def test_header_texts_of_claimed_files_are_shuffled_once(spark, tmp_path):
    folder = str(tmp_path)
    rows = [("/s/p/2020/1/g.nc", header())]
    write_header_store(named_headers(spark.createDataFrame(rows, "path string, header string"), "/s/"), folder)
    claimed = spark.createDataFrame([("g.nc", "/s/p/2020/1/g.nc")], "filename string, path string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = located_headers(claimed, read_header_store(spark, folder), "/s")
        assert [r.path for r in found.collect()] == ["/s/p/2020/1/g.nc"]
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert lines and not any("struct" in line or "_key" in line for line in lines)


def test_only_headers_that_share_a_version_are_shuffled_as_texts(spark):
    schema = "name string, header string, version bigint, day string"
    plain = [(f"p/2020/1/g{i}.nc", header(px=i), 1, "p/2020/1") for i in range(6)]
    older = [("p/2020/1/g0.nc", header(px=70), 0, "p/2020/1"), ("p/2020/1/g2.nc", "{", 2, "p/2020/1")]
    older += [("p/2020/1/g3.nc", None, 3, "p/2020/1"), ("p/2020/1/g4.nc", header(px=74), None, "p/2020/1")]
    tied = [("p/2020/1/g5.nc", header(px=px), 4, "p/2020/1") for px in (75, 79, 77)]
    tied += [("p/2020/1/g1.nc", text, 4, "p/2020/1") for text in (None, header(px=71))]
    files = [(f"g{i}.nc", f"/s/p/2020/1/g{i}.nc", T0, kind) for i in range(7) for kind in ("mcm", "rad", "none")]
    claimed = spark.createDataFrame(files, "filename string, path string, mtime timestamp_ntz, file_type string")

    def lines(rows):
        stored = spark.createDataFrame(rows, schema)
        found = extract_lines(claimed, stored, CONFIG, "/s", "/s")
        want = with_csv_line(located_headers(claimed, stored, "/s"), CONFIG, "/s").filter("csv_line is not null")
        got = sorted(found.collect())
        assert got == sorted(want.select("filename", "path", "mtime", "csv_line").collect())
        plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return {r.filename: r.csv_line.split(",")[-1] for r in got if r.csv_line.count(",") == 1}, "max_by(header" in plan

    found, shuffled = lines(plain + older)
    assert set(found) == {"g0.nc", "g1.nc", "g4.nc", "g5.nc"} and not shuffled
    found, shuffled = lines(plain + older + tied)
    assert found["g5.nc"] == "79" and found["g1.nc"] == "71" and shuffled


# --- queue ------------------------------------------------------------------
@pytest.mark.parametrize(
    ("cap", "batch", "rows"), [(120, 50, 150), (0, 50, 0), (-1, 50, None), (100, 50, 100), (-7, 50, 0)]
)
def test_caps_are_whole_batches(cap, batch, rows):
    assert claim_rows(batch, cap) == rows


def test_claim_takes_the_oldest_queued_rows(spark):
    table = tracked(
        spark,
        ("P", "/c", "", 2, "x", 1),
        ("P", "/b", "", 1, "x", 1),
        ("P", "/a", "", 1, "x", 1),
        ("P", "/d", "", 1, "x", 2),
        ("Q", "/e", "", 1, "x", 1),
    )
    assert sorted(r.path for r in claim(table, "P", 2).collect()) == ["/a", "/b"]
    assert sorted(r.path for r in claim(table, "P", None).collect()) == ["/a", "/b", "/c"]
    assert claim(table, "P", 0).count() == 0


def test_updates_reach_every_row_of_a_file_name_and_the_last_line_stays(spark):
    table = tracked(
        spark,
        ("P", "/x/f.nc", "old", 1, "x", 1),
        ("P", "/y/f.nc", "old", 2, "x", 0),
        ("P", "/z/g.nc", "old", 1, "x", 0),
        ("Q", "/x/f.nc", "old", 1, "x", 1),
    )
    claimed = claim(table, "P", None)
    assert state(apply_updates(table, claimed_updates(claimed, "P"))) == {
        ("P", "/x/f.nc"): ("", 2),
        ("P", "/y/f.nc"): ("", 2),
        ("P", "/z/g.nc"): ("old", 0),
        ("Q", "/x/f.nc"): ("old", 1),
    }
    lines = spark.createDataFrame(
        [("f.nc", "/y/f.nc", datetime(2020, 1, 2), "late"), ("f.nc", "/x/f.nc", T0, "early")],
        "filename string, path string, mtime timestamp_ntz, csv_line string",
    )
    done = state(apply_updates(table, done_updates(lines, "P")))
    assert done[("P", "/x/f.nc")] == done[("P", "/y/f.nc")] == ("late", 0)
    assert done[("Q", "/x/f.nc")] == ("old", 1)
    none = lines.limit(0).selectExpr("'P' project", "filename", "'' data", "1 inqueue")
    assert apply_updates(table, none).count() == 4


# --- mapping ----------------------------------------------------------------
def test_columns_are_sorted_and_sections_may_be_absent():
    assert mapped_header_line(CONFIG, "rad") == "absent,base_url,pixels,scene,west"
    assert mapped_header_line(CONFIG, "mcm") == "base_url,pixels"
    assert [name for name, _ in mapped_columns({})] == ["base_url"]


@pytest.mark.parametrize(
    "config",
    [
        {"metadata": {"a": "x", "b": "x"}},
        {"metadata": {"a": "x"}, "data": {"v": {"b": "x"}}},
        {"data": {"v": "base_url"}},
        {"metadata": {"a": {"b": "x"}}},
    ],
)
def test_ambiguous_configs_are_refused(config):
    with pytest.raises(ValueError, match="map"):
        mapped_columns(config)


def test_config_file(spark, tmp_path):
    path = tmp_path / "config.json"
    path.write_text(json.dumps(CONFIG, indent=2))
    assert load_mapping(spark, str(path)) == CONFIG


def test_lines(spark):
    rows = [
        ("/store/a.nc", "rad", header()),
        ("/store/b.nc", "mcm", header(px=[1, [2, 3]])),
        ("/store/c.nc", "rad", header(scene='a,"b"', px=None, west=1e-5)),
        ("/store/d.nc", "rad", "no header"),
        ("/store/e.nc", "new", header()),
        ("/store/f.nc", "rad", "{}"),
    ]
    files = spark.createDataFrame(rows, "path string, file_type string, header string")
    lines = {r.path[7]: r.csv_line for r in with_csv_line(files, CONFIG, "/store").collect()}
    assert lines == {
        "a": ",gs://a.nc,1,s,2.5",
        "b": 'gs://b.nc,"[1,[2,3]]"',
        "c": ',gs://c.nc,,"a,""b""",1e-05',
        "d": None,
        "e": None,
        "f": ",gs://f.nc,,,",
    }
    mapped = {r.path[7]: tuple(r)[2:] for r in records(files, CONFIG, "/store").collect()}
    assert mapped == {
        "a": (None, "gs://a.nc", "1", "s", "2.5"),
        "b": (None, "gs://b.nc", "[1,[2,3]]", None, None),
        "c": (None, "gs://c.nc", None, 'a,"b"', "1.0E-5"),
        "f": (None, "gs://f.nc", None, None, None),
    }


def test_names_differing_in_case_only(spark):
    config = {"t": {"metadata": {"Id": "upper", "id": "lower"}}}
    text = json.dumps({"attributes": {"Id": "A", "id": "a"}, "variables": {}})
    files = spark.createDataFrame([("p", "t", text)], "path string, file_type string, header string")
    assert with_csv_line(files, config, "/store").first().csv_line == "p,a,A"


# --- jobs -------------------------------------------------------------------
def test_walk_process_export(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path / "tracking"), "P/1")
    listing = spark.createDataFrame(
        [(f"/store/r/{i}.nc", datetime(2020, 1, 9 - i)) for i in range(4)], LISTED
    )
    assert store.read().count() == 0
    walk(store, listing, "/store", ["r/*.nc"], ["rad"])
    walk(store, listing, "/store", ["r/*.nc"], ["rad"])
    assert store.read().count() == 4
    headers = spark.createDataFrame(
        [(f"/store/r/{i}.nc", "broken" if i == 2 else header(px=i)) for i in range(4)],
        "path string, header string",
    )
    first = process(store, headers, CONFIG, "/store", batch_size=1, max_to_process=1)
    assert (first.claimed, first.processed, first.rejected, first.still_queued) == (1, 1, 0, 3)
    rejects = str(tmp_path / "rejects")
    rest = process(store, headers, CONFIG, "/store", rejects=rejects)
    assert [r.path for r in spark.read.parquet(rejects).collect()] == ["/store/r/2.nc"]
    assert (rest.claimed, rest.processed, rest.rejected, rest.still_queued) == (3, 2, 1, 0)
    assert process(store, headers, CONFIG, "/store").claimed == 0
    states = {r.path: (r.data, r.inqueue) for r in store.read().collect()}
    assert states["/store/r/2.nc"] == ("", 2)
    assert states["/store/r/0.nc"] == (",gs://r/0.nc,0,s,2.5", 0)
    out = tmp_path / "export"
    export(store, CONFIG, "rad", str(out))
    text = "".join(part.read_text() for part in sorted(out.glob("part-*")))
    assert text.split("\n") == [
        "absent,base_url,pixels,scene,west",
        ",gs://r/3.nc,3,s,2.5",
        ",gs://r/1.nc,1,s,2.5",
        ",gs://r/0.nc,0,s,2.5",
        "",
    ]
    listing = spark.createDataFrame([("/store/r/9.nc", T0)], LISTED)
    walk(store, listing, "/store", ["r/*.nc"], ["rad"])
    assert store.read().filter(F.col("inqueue") == 1).count() == 1


def test_projects_share_a_table_and_do_not_see_each_other(spark, tmp_path):
    stores = [TrackingStore(spark, str(tmp_path / "it's"), project) for project in ("P/1", "Q")]
    for store in stores:
        assert store.read().count() == store.files().count() == 0
        store.append(tracked(spark, (store.project, "/a", "", 1, "x", 1)))
    stores[0].update(tracked(spark, ("P/1", "/a", "d", 1, "x", 0)).select("project", "path", "data", "inqueue"))
    assert [state(store.read()) for store in stores] == [{("P/1", "/a"): ("d", 0)}, {("Q", "/a"): ("", 1)}]
    assert stores[0].whole().count() == 2 and stores[0].read().schema.names == TRACKING_SCHEMA.names
    stores[0].fold()
    assert len(stores[0].loads()) == len(stores[1].loads()) == 1
    again = TrackingStore(spark, str(tmp_path / "it's"), "P/1")
    assert state(again.whole()) == {("P/1", "/a"): ("d", 0), ("Q", "/a"): ("", 1)}


def test_writes_that_overlap_a_fold_stay(spark, tmp_path, monkeypatch):
    """One row is added and one changed between the fold's reading and its writing."""
    store = TrackingStore(spark, str(tmp_path), "P")
    store.append(tracked(spark, ("P", "/a", "", 1, "x", 1), ("P", "/b", "", 1, "x", 1)))
    store.update(tracked(spark, ("P", "/a", "", 1, "x", 2)).select("project", "path", "data", "inqueue"))
    other = TrackingStore(spark, str(tmp_path), "P")
    write = store._write

    def late_write(*given):
        other.append(tracked(spark, ("P", "/c", "", 1, "x", 1)))
        other.update(tracked(spark, ("P", "/a", "line", 1, "x", 0)).select("project", "path", "data", "inqueue"))
        write(*given)

    monkeypatch.setattr(store, "_write", late_write)
    store.fold()
    expected = {("P", "/a"): ("line", 0), ("P", "/b"): ("", 1), ("P", "/c"): ("", 1)}
    assert state(store.read()) == expected and len(store.loads()) == 3
    other.fold()
    assert state(store.read()) == expected and len(store.loads()) == 1


def test_text_that_looks_like_a_number_stays(spark):
    rows = [
        ("/store/a.nc", "rad", header(scene="1.0E7", west=1e7)),
        ("/store/b.nc", "rad", header(scene="x", px="2.5E8", west=-1e-5)),
    ]
    files = spark.createDataFrame(rows, "path string, file_type string, header string")
    lines = {r.path[7]: r.csv_line for r in with_csv_line(files, CONFIG, "/store").collect()}
    assert lines == {"a": ",gs://a.nc,1,1.0E7,10000000.0", "b": ",gs://b.nc,2.5E8,x,-1e-05"}


def test_updates_cost_their_own_size_and_the_latest_counts(spark, tmp_path):
    store = TrackingStore(spark, str(tmp_path), "P")
    table = tracked(
        spark, ("P", "/x/f", "", 1, "x", 1), ("P", "/y/f", "", 1, "x", 1), ("P", "/g", "", 1, "x", 1), ("Q", "/x/f", "", 1, "x", 1)
    )
    store.append(table)
    names = spark.createDataFrame([("f",)], "filename string")
    store.update(changed_rows(store.files(), claimed_updates(names, "P")))
    assert spark.table(store.table).filter(F.col("load") == store.loads()[-1]).count() == 2
    changed = {("P", "/x/f"): ("", 2), ("P", "/y/f"): ("", 2), ("P", "/g"): ("", 1), ("Q", "/x/f"): ("", 1)}
    assert state(store.whole()) == changed
    # a later addition of the same name is not reached by the claim before it
    store.append(tracked(spark, ("P", "/z/f", "", 1, "x", 1)))
    lines = spark.createDataFrame([("f", "/x/f", T0, "line")], "filename string, path string, mtime timestamp_ntz, csv_line string")
    assert state(store.read())[("P", "/z/f")] == ("", 1)
    store.update(changed_rows(store.files().filter("path <> '/z/f'"), done_updates(lines, "P")))
    expected = changed | {("P", "/x/f"): ("line", 0), ("P", "/y/f"): ("line", 0), ("P", "/z/f"): ("", 1)}
    assert state(store.whole()) == expected
    # a state of a row that was never added adds none
    store.update(tracked(spark, ("P", "/never", "", 1, "x", 2)).select("project", "path", "data", "inqueue"))
    store.fold()
    assert len(store.loads()) == 1 and state(store.whole()) == expected
