import json
from pathlib import Path

import pytest

from documents import CATEGORIES, product, session, shop, transaction
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from souk import schemas
from souk.operators import flatten, keyed, revenue
from souk.plans import nightly
from souk.sinks import tables, upserts
from souk.sources import json_files
from souk.sources.shop import from_documents


def dump(path, data):
    path.write_text(json.dumps(data, indent=2))


def as_json(df):
    return [json.loads(r) for r in df.toJSON().collect()]


@pytest.fixture
def documents(spark, tmp_path):
    """The five entities as indented JSON arrays; sessions in two shards."""

    def frame(rows, entity):
        return as_json(spark.createDataFrame(rows, schemas.ENTITIES[entity]))

    carts = [session(i, "u", cart={f"p{i}": (i, 2.0), "px": (1, 1.0)}, viewed=["p1"]) for i in range(1, 5)]
    dump(tmp_path / "sessions_0.json", frame(carts[:3], "sessions"))
    dump(tmp_path / "sessions_1.json", frame(carts[3:], "sessions"))
    dump(tmp_path / "categories.json", frame(CATEGORIES, "categories"))
    dump(tmp_path / "products.json", frame([product("p1", "Kawa")], "products"))
    dump(tmp_path / "transactions.json", frame([transaction(1, "u", [("p1", 2, 3.5)])], "transactions"))
    dump(tmp_path / "users.json", [{"user_id": "u", "geo_data": {"city": "Gasabo"}}])
    return tmp_path


def test_nested_documents_end_to_end(spark, documents, rows):
    read = {e: json_files.read_entity(spark, str(documents), e) for e in schemas.ENTITIES}
    s = from_documents(**read)
    assert s.sessions.count() == 4
    assert read["sessions"].schema["cart_contents"].dataType.typeName() == "map"
    assert rows(s.cart_quantities.groupBy("product_id").sum("quantity"))[-1] == ("px", 4)
    assert rows(revenue.product_revenue(s.lines)) == [("p1", 7.0, 2, 1)]
    assert s.users.first().registered_at is None


def test_documents_and_views_in_sql(spark, documents):
    json_files.register_views(sessions=json_files.read_entity(spark, str(documents), "sessions"))
    got = spark.sql("SELECT sum(c.quantity) FROM sessions LATERAL VIEW explode(cart_contents) AS product_id, c")
    assert got.first()[0] == 14


def test_load_prefers_the_table_and_names_missing_files(spark, documents, tmp_path):
    where = (str(tmp_path / "tables"), str(documents))
    names = ["sessions_0.json", "sessions_1.json", "sessions_7.json"]
    missing = []
    assert json_files.load(spark, "sessions", *where, names, missing).count() == 4
    assert missing == [f"{documents}/sessions_7.json"]
    with pytest.raises(AnalysisException):
        json_files.load(spark, "sessions", *where, names)
    assert json_files.load(spark, "users", *where).count() == 1
    assert json_files.load(spark, "products", *where, ["none.json"], missing).count() == 0
    spark.createDataFrame([("x", "id")], "product_id string, _id string").write.parquet(f"{where[0]}/products")
    stored = json_files.load(spark, "products", *where)
    assert stored.columns == ["product_id"] and stored.count() == 1


def test_malformed_text_is_an_error(spark, tmp_path):
    (tmp_path / "users.json").write_text('[{"user_id": "u"')
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        json_files.read_entity(spark, str(tmp_path), "users").count()


def test_one_object_is_one_row(spark, tmp_path):
    dump(tmp_path / "users.json", {"user_id": "u"})
    assert json_files.read_entity(spark, str(tmp_path), "users").count() == 1


@pytest.mark.parametrize("indent", [None, 0, 1, 2, 4])
def test_records_of_any_layout(spark, tmp_path, indent):
    users = [{"user_id": f"u{i}", "geo_data": {"city": 'a "q"\n  {x},'}} for i in range(5)]
    texts = [users, users[:1], [], {"user_id": "u"}, [{}, {}]]
    for i, data in enumerate(texts):
        (tmp_path / f"{i}.json").write_text(json.dumps(data, indent=indent) + "\n" * (i % 2))
        path = str(tmp_path / f"{i}.json")
        found = json_files.read_json_records(spark, path, schemas.ENTITIES["users"])
        want = json_files.read_json_array(spark, path, schemas.ENTITIES["users"])
        assert found.where(f"{json_files.MALFORMED} IS NOT NULL").count() == 0
        assert as_json(found.drop(json_files.MALFORMED)) == as_json(want)


def test_one_array_is_read_by_many_tasks(spark, tmp_path):
    dump(tmp_path / "users.json", [{"user_id": f"u{i:06d}", "geo_data": {"city": "Gasabo"}} for i in range(20_000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        found = json_files.read_entity_records(spark, str(tmp_path), "users")
        tasks = found.groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 3
        assert sorted(r[0] for r in found.select("user_id").collect()) == [f"u{i:06d}" for i in range(20_000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize(
    ("text", "good", "bad"),
    [
        ('[\n  {\n    "user_id": "u"\n  },\n  {\n    "user_id": oops\n  },\n  {\n    "user_id": "w"\n  }\n]', ["u", "w"], 1),
        ('[\n  {\n    "user_id": "u"\n  },\n  {\n    "user_id": "v"', ["u"], 1),  # cut short
        ('[\n  {\n    "user_id": "u",\n    "geo_data": 7\n  }\n]', [], 1),  # another type
        ('[{"user_id": "u"}, 5, null]', ["u"], 2),
        ('[{"user_id": "u"}', [], 1),
        ("", [], 0),
        ("no json", [], 1),
    ],
)
def test_malformed_records_are_set_aside(spark, tmp_path, text, good, bad):
    (tmp_path / "users.json").write_text(text)
    found = json_files.read_entity_records(spark, str(tmp_path), "users")
    assert [r.user_id for r in found.where(f"{json_files.MALFORMED} IS NULL").collect()] == good
    assert found.where(f"{json_files.MALFORMED} IS NOT NULL").count() == bad


def test_categories_file_becomes_one_line_per_subcategory(spark, documents, tmp_path):
    cats = json_files.read_entity(spark, str(documents), "categories")
    s = from_documents(
        categories=cats,
        **{e: spark.createDataFrame([], ddl) for e, ddl in schemas.ENTITIES.items() if e != "categories"},
    )
    got = flatten.export_categories(s.categories, s.subcategories).orderBy("subcategory_id").coalesce(1)
    assert tables.write_csv(got, f"{tmp_path}/c") == 3
    assert csv_text(f"{tmp_path}/c") == [
        "category_id,category_name,subcategory_id,subcategory_name,profit_margin",
        "cat_1,Fresh Produce,sub_1,Fruits,0.2",
        "cat_1,Fresh Produce,sub_2,Herbs,0.3",
        "cat_2,Coffee & Tea,sub_3,Green Tea,0.25",
    ]


def csv_text(path):
    return [line for part in sorted(Path(path).glob("part-*")) for line in part.read_text().splitlines()]


def test_csv_has_a_header_even_when_empty(spark, tmp_path):
    df = spark.createDataFrame([("a", True, None, "")], "t string, b boolean, n int, e string").coalesce(1)
    assert tables.write_csv(df, f"{tmp_path}/one") == 1
    assert csv_text(f"{tmp_path}/one") == ["t,b,n,e", 'a,true,,""']
    assert tables.write_csv(df.limit(0), f"{tmp_path}/none") == 0
    assert csv_text(f"{tmp_path}/none") == ["t,b,n,e"]


def test_replace_load(spark, tmp_path):
    one, two = spark.createDataFrame([("a",)], "k string"), spark.createDataFrame([("b",), ("b",)], "k string")
    path = tables.replace_table(one, str(tmp_path), "t", ("k",))
    with pytest.raises(ValueError, match="occurs 2 times"):
        tables.replace_table(two, str(tmp_path), "t", ("k",))
    assert spark.read.parquet(path).count() == 1
    tables.replace_table(two, str(tmp_path), "t")
    assert spark.read.parquet(path).count() == 2


def test_month_layout(spark, tmp_path):
    s = shop(
        spark,
        transactions=[transaction(i, f"u{i % 3}", [], ts=f"2025-0{1 + i % 2}-0{1 + i}T00:00:00") for i in range(8)],
    )
    tables.write_by_month(s.transactions, f"{tmp_path}/t")
    stored = spark.read.parquet(f"{tmp_path}/t")
    assert stored.count() == 8
    assert {p.name for p in (tmp_path / "t").glob("order_month=*")} == {"order_month=2025-01", "order_month=2025-02"}
    plan = stored.where("order_month = '2025-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_partitioned_and_sharded_output(spark, tmp_path):
    df = spark.createDataFrame([(i, "Kigali" if i % 2 else "Western") for i in range(40)], "id int, province string")
    tables.write_partitioned(df, f"{tmp_path}/p", "province")
    assert len(list((tmp_path / "p").glob("province=*"))) == 2
    assert len(list((tmp_path / "p").glob("province=*/part-*"))) == 2
    tables.write_json_shards(df, f"{tmp_path}/j", 4)
    assert len(list((tmp_path / "j").glob("part-*"))) == 4
    assert spark.read.json(f"{tmp_path}/j").count() == 40


def test_keyed_table_skips_files_by_range(spark, tmp_path):
    sessions = [session(i, f"user_{i % 20:02d}", start=f"2025-01-{1 + i % 28:02d}T00:00:00") for i in range(200)]
    table = keyed.session_keyed_table(shop(spark, sessions=sessions).session_cells)
    tables.write_keyed(table, f"{tmp_path}/k", 5)
    stored = spark.read.parquet(f"{tmp_path}/k")
    assert stored.count() == table.count()
    read = keyed.user_sessions(stored, "user_07", 100)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(row_key,user_07#), LessThan(row_key,user_07$)" in plan
    assert {r.row_key.split("#")[0] for r in read.collect()} == {"user_07"}
    ranges = spark.sql(f"SELECT min(row_key) lo, max(row_key) hi FROM parquet.`{tmp_path}/k` GROUP BY _metadata.file_name")
    spans = sorted((r.lo, r.hi) for r in ranges.collect())
    assert len(spans) == 5 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_preview(spark):
    rows, total = tables.preview(spark.range(9))
    assert (rows.count(), total) == (5, 9)


def test_nightly_batch(spark, documents, tmp_path):
    out = f"{tmp_path}/work"
    exported = nightly.run(spark, str(documents), out)
    assert exported == {
        "users": 1,
        "products": 1,
        "transactions": 1,
        "transaction_items": 1,
        "sessions": 4,
        "categories": 3,
    }
    assert spark.read.parquet(f"{out}/tables/products").first().category_name == "Fresh Produce"
    assert spark.read.parquet(f"{out}/results/clv").first().total_spend == 7.0
    assert spark.read.parquet(f"{out}/results/user_sessions").count() == 1
    kept = {r.reason: r.row_count for r in spark.read.parquet(f"{out}/tables/session_report").collect()}
    assert sum(kept.values()) == 4 and spark.read.parquet(f"{out}/tables/clean/sessions").count() == kept["kept"]


def test_a_large_folder_is_written_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "ROWS_PER_FILE", 10)
    df = spark.createDataFrame([(i, "Kigali" if i % 10 else None, {"k": i}) for i in range(100)], "id int, province string, m map<string,int>")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else tasks of so few rows are put together
    try:
        tables.write_partitioned(df, f"{tmp_path}/p", "province")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{tmp_path}/p").count() == 100
    assert 1 < len(list((tmp_path / "p").glob("province=Kigali/part-*"))) <= 9


def test_stored_sessions_take_batches_and_give_one_user(spark, tmp_path, rows):
    columns = "row_key string, sess_session_id string, sess_conversion_status string"
    first = [(f"u{u}#{k:03d}", f"s{u}{k}", "browsing") for u in range(30) for k in range(5)]
    table = upserts.keyed_sessions(spark, str(tmp_path), spark.createDataFrame([], columns).schema, parts=8)
    table.merge(spark.createDataFrame(first, columns), 0)
    table.merge(spark.createDataFrame([("u7#001", "s70", "old"), ("u7#002", "s99", "converted"), ("u7#009", "s9", "new")], columns), 1)
    found = upserts.sessions_of_user(table, "u7")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and "GreaterThanOrEqual(row_key,u7#)" in plan
    assert len({f.rpartition("/")[0] for f in found.inputFiles()}) == 8  # all that there are; the scan opens one
    want = [("u7#000", "s70"), ("u7#001", "s71"), ("u7#002", "s99"), ("u7#003", "s73"), ("u7#004", "s74"), ("u7#009", "s9")]
    assert rows(found.select("row_key", "sess_session_id")) == want
    assert upserts.sessions_of_user(table, "nobody").count() == 0 and table.read().count() == 151


def test_nightly_load_counts_and_stores_malformed_records(spark, documents, tmp_path):
    path = documents / "sessions_1.json"
    whole = json.loads(path.read_text())
    path.write_text(path.read_text()[:-2] + ',\n  {\n    "session_id": broken\n  }\n]')
    categories = documents / "categories.json"
    categories.write_text(categories.read_text()[:-2] + ',\n  {\n    "category_id": \n  }\n]')
    out = f"{tmp_path}/work"
    nightly.load_tables(spark, str(documents), out)
    report = {r.entity: (r.records, r.malformed) for r in spark.read.parquet(f"{out}/load_report").collect()}
    sessions = spark.read.parquet(f"{out}/sessions").count()
    assert len(whole) >= 1 and report["sessions"] == (sessions + 1, 1)
    assert report["categories"] == (spark.read.parquet(f"{out}/categories").count() + 1, 1)
    assert report["users"] == (1, 0) and report["products"] == (1, 0)
    assert "broken" in spark.read.parquet(f"{out}/malformed/sessions").first()[0]
    assert spark.read.parquet(f"{out}/malformed/users").count() == 0
    nightly.load_tables(spark, str(documents), out)  # a second run replaces all of it
    assert spark.read.parquet(f"{out}/malformed/sessions").count() == 1
