import json

from granulake.__main__ import run
from granulake.sources.granules import write_header_store
from test_products import header as product_header
from test_streaming import message, name_of


def test_catalogue_jobs(spark, tmp_path):
    files = tmp_path / "store" / "ABI-L1b-RadM" / "2017" / "001" / "00"
    files.mkdir(parents=True)
    for n in (1, 2):
        (files / f"{n}.nc").write_bytes(b"x")
    root = f"{tmp_path}/store"
    header = json.dumps({"attributes": {"scene_id": "s"}, "variables": {}})
    spark.createDataFrame(
        [(f"{files}/{n}.nc", header) for n in (1, 2)], "path string, header string"
    ).write.parquet(f"{tmp_path}/headers")
    (tmp_path / "map.json").write_text(json.dumps({"rad": {"metadata": {"scene_id": "scene"}}}))
    tracking = ["--tracking", f"{tmp_path}/tracking"]
    config = ["--config", f"{tmp_path}/map.json"]
    run(spark, ["walk", *tracking, "--location-root", f"file://{root}"])
    store = f"{tmp_path}/header-store"
    at_root = ["--location-root", root]
    run(spark, ["headers", "--input", f"{tmp_path}/headers", *at_root, "--store", store])
    run(spark, ["process", *tracking, *config, *at_root, "--headers", store, "--store-prefix", root])
    run(spark, ["compact", *tracking])
    run(spark, ["export", *tracking, *config, "--output", f"{tmp_path}/out"])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "out").glob("part-*"))).split("\n")
    assert lines[0] == "base_url,scene"
    assert sorted(lines[1:3]) == [
        f"gs://ABI-L1b-RadM/2017/001/00/{n}.nc,s" for n in (1, 2)
    ]


def test_ingest(spark, tmp_path):
    name = name_of("glm_l2_lcfa", 1)
    rows = [(name, json.dumps(product_header("glm_l2_lcfa")))]
    write_header_store(
        spark.createDataFrame(rows, "name string, header string"), f"{tmp_path}/headers"
    )
    (tmp_path / "messages").mkdir()
    (tmp_path / "messages" / "a.txt").write_text(message(name) + "\n")
    database = f"cli_{tmp_path.name.replace('-', '_')}"
    run(
        spark,
        [
            "ingest",
            *("--messages", f"{tmp_path}/messages"),
            *("--headers", f"{tmp_path}/headers"),
            *("--database", database),
            *("--tables", f"{tmp_path}/tables"),
            *("--checkpoint", f"{tmp_path}/log"),
        ],
    )
    assert spark.table(f"`{database}`.glm_l2_lcfa").count() == 1
