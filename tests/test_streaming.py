import json
import uuid

import pytest

from granulake.operators.messages import kept, parse_messages
from granulake.plans.ingest import Ingest, attach_headers
from granulake.schemas import PRODUCT_SCHEMAS
from granulake.sinks.product_tables import REJECTS, ProductTables
from granulake.sources.granules import read_header_store, write_header_store
from granulake.sources.notifications import batch_files, stream_files
from granulake.streaming.ingest import load_batch, start_ingest
from test_products import header

FOLDERS = {
    "abi_l1b_radiance": "ABI-L1b-RadF",
    "abi_l2_cmip": "ABI-L2-CMIPM",
    "abi_l2_mcmip": "ABI-L2-MCMIPM",
    "glm_l2_lcfa": "GLM-L2-LCFA",
}


def name_of(table, number):
    return f"{FOLDERS[table]}/2020/188/06/g{number}.nc"


def message(name, **changes):
    return json.dumps({"id": "i", "name": name, "size": "5"} | changes)


@pytest.fixture
def place(spark, tmp_path):
    class Place:
        messages = tmp_path / "messages"
        store = str(tmp_path / "headers")
        tables = ProductTables(spark, f"t_{uuid.uuid4().hex[:8]}", str(tmp_path / "tables"))

        def send(self, *texts):
            self.messages.mkdir(exist_ok=True)
            (self.messages / f"{uuid.uuid4().hex}.txt").write_text("\n".join(texts) + "\n")

        def headers(self, *numbers, **changes):
            rows = [
                (name_of(t, n), json.dumps(header(t, **changes))) for t in FOLDERS for n in numbers
            ]
            write_header_store(spark.createDataFrame(rows, "name string, header string"), self.store)

        def run(self, log="log"):
            start_ingest(
                stream_files(spark, str(self.messages)),
                lambda session: read_header_store(session, self.store),
                self.tables,
                str(tmp_path / log),
            ).awaitTermination()

        def urls(self):
            return {
                t: sorted(r.base_url.rsplit("/", 1)[1] for r in self.tables.read(t).collect())
                for t in PRODUCT_SCHEMAS
            }

        def reasons(self):
            return sorted(r.reason for r in self.tables.read(REJECTS).collect())

    return Place()


def test_stream_fills_tables_once_and_sees_later_files(place):
    place.headers(1)
    place.send(*[message(name_of(t, 1)) for t in FOLDERS], "broken", message("other/x.nc"))
    place.run()
    assert place.urls() == {t: ["g1.nc"] for t in FOLDERS}
    assert place.reasons() == ["malformed"]
    place.run()
    assert place.urls() == {t: ["g1.nc"] for t in FOLDERS}
    place.headers(2)
    again = message(name_of("glm_l2_lcfa", 2))
    place.send(again, again, message(name_of("abi_l2_cmip", 9)))
    place.run()
    assert place.urls()["glm_l2_lcfa"] == ["g1.nc", "g2.nc", "g2.nc"]  # repeats are kept
    assert place.reasons() == ["malformed", "object_not_found"]
    for table, schema in PRODUCT_SCHEMAS.items():
        assert place.tables.read(table).schema == schema


def test_a_new_checkpoint_loads_again_beside_the_old_rows(place):
    place.headers(1)
    place.send(message(name_of("glm_l2_lcfa", 1)))
    place.run("log-a")
    place.run("log-b")
    assert place.urls()["glm_l2_lcfa"] == ["g1.nc", "g1.nc"]


def test_a_retried_batch_replaces_its_own_rows(spark, place):
    place.headers(1)
    place.tables.ensure()
    assert place.tables.ensure() == []
    texts = [message(name_of("glm_l2_lcfa", n)) for n in (1, 2)]
    batch = spark.createDataFrame([(t,) for t in texts], "value string")
    load_batch(batch, read_header_store(spark, place.store), place.tables, "run", 0)
    assert place.reasons() == ["object_not_found"]
    place.headers(2)
    load_batch(batch, read_header_store(spark, place.store), place.tables, "run", 0)
    assert place.urls()["glm_l2_lcfa"] == ["g1.nc", "g2.nc"] and place.reasons() == []


def test_batch_rejects(spark, place):
    place.headers(1, event_count="bad", valid_pixel_count="bad", outlier_pixel_count_c01="bad")
    wanted = name_of("glm_l2_lcfa", 1)
    place.send(
        message(wanted),
        message(wanted, size="x"),
        json.dumps({"name": wanted, "id": 1}),
        message(wanted, id=None).replace("}", "}}"),
        message(name_of("abi_l1b_radiance", 1)),
        message(name_of("abi_l2_cmip", 7)),
    )
    batch = Ingest(batch_files(spark, str(place.messages)), read_header_store(spark, place.store))
    found = sorted((r.reason, r.table_name) for r in batch.rejects().collect())
    assert found == [
        ("bad_value", "abi_l1b_radiance"),
        ("bad_value", "glm_l2_lcfa"),
        ("bad_value", "glm_l2_lcfa"),
        ("malformed", None),
        ("missing_size", "glm_l2_lcfa"),
        ("object_not_found", "abi_l2_cmip"),
    ]
    assert batch.product("glm_l2_lcfa").count() == 0


def test_values_come_from_their_own_message(spark, place):
    place.headers(*range(20))
    texts = [message(name_of("glm_l2_lcfa", n), size=str(n)) for n in range(20)]
    batch = Ingest(
        spark.createDataFrame([(t,) for t in texts], "value string").repartition(5),
        read_header_store(spark, place.store),
    )
    rows = batch.product("glm_l2_lcfa").collect()
    assert sorted(r.total_size for r in rows) == list(range(20))
    assert all(r.base_url.endswith(f"/g{r.total_size}.nc") for r in rows)


def test_an_object_announced_over_and_over_is_split(spark, place):
    """A third of the messages name one object; no task gets them all."""
    place.headers(*range(300))
    names = [name_of("glm_l2_lcfa", 0 if n % 3 == 0 else n % 300) for n in range(30000)]
    messages = spark.createDataFrame(
        [(message(name, id=uuid.uuid4().hex * 4),) for name in names], "value string"
    ).repartition(8)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = attach_headers(
            kept(parse_messages(messages)), read_header_store(spark, place.store)
        )
        assert joined.toArrow().num_rows == 30000
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert "skew=true" in plan


def test_small_batches_prune_the_header_store_by_day(spark, place):
    place.headers(1)
    messages = spark.createDataFrame([(message(name_of("glm_l2_lcfa", 1)),)], "value string")
    joined = attach_headers(
        kept(parse_messages(messages)), read_header_store(spark, place.store)
    )
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "dynamicpruning" in plan
    assert joined.count() == 1


def test_a_header_stored_again_counts_once_and_the_latest_counts(spark, place):
    name = name_of("glm_l2_lcfa", 1)
    for title in ("old", "new", "new"):
        rows = [(name, json.dumps(header("glm_l2_lcfa", dataset_name=title)))]
        write_header_store(spark.createDataFrame(rows, "name string, header string"), place.store)
    messages = spark.createDataFrame([(message(name),)], "value string")
    batch = Ingest(messages, read_header_store(spark, place.store))
    assert [r.dataset_name for r in batch.product("glm_l2_lcfa").collect()] == ["new"]
    assert batch.rejects().count() == 0


def test_state_has_no_more_partitions_than_cores_ask_for(spark, place, tmp_path, monkeypatch):
    from granulake.streaming import ingest

    name, seen = "spark.sql.shuffle.partitions", []
    before, load = spark.conf.get(name), ingest.load_batch

    def noted(batch, *rest):
        seen.append(batch.sparkSession.conf.get(name))
        load(batch, *rest)

    monkeypatch.setattr(ingest, "load_batch", noted)
    monkeypatch.setattr(ingest, "STATE_PARTITIONS_A_CORE", 1, raising=False)
    place.headers(1)
    place.send(message(name_of("glm_l2_lcfa", 1)), message(name_of("glm_l2_lcfa", 1)))
    spark.conf.set(name, "30")
    try:
        start_ingest(
            stream_files(spark, str(place.messages)), lambda s: read_header_store(s, place.store), place.tables, str(tmp_path / "log"), distinct_within=60
        ).awaitTermination()
        assert spark.conf.get(name) == "30"
    finally:
        spark.conf.set(name, before)
    assert place.urls()["glm_l2_lcfa"] == ["g1.nc"] and set(seen) == {"30"}
    parts = [p.name for p in (tmp_path / "log" / "state" / "0").iterdir() if p.name.isdigit()]
    assert len(parts) == spark.sparkContext.defaultParallelism
