import json
from types import SimpleNamespace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinshelf import schemas, session
from twinshelf.functions.documents import nested_as_text, parse
from twinshelf.operators import selection
from twinshelf.operators.ordering import number_rows, number_within
from twinshelf.sources import pages, products, tables


def raw(spark, *documents):
    lines = [d if isinstance(d, str) else json.dumps(d, ensure_ascii=False) for d in documents]
    return spark.createDataFrame([(line,) for line in lines], "raw string")


def test_seller_documents(spark):
    seller = {"product_id": 1, "price": 10, "store_id": 2, "name": "s"}
    dear = {**seller, "price": 3_000_001}
    docs = raw(
        spark,
        {"id": 1, "name": "máy", "categories": {"name": "c"}, "brand": {"name": "b"},
         "other_sellers": [seller, seller], "current_seller": dear},
        {"id": 2, "other_sellers": [], "current_seller": seller},
        {"id": 3, "current_seller": None},
        {"id": 0, "other_sellers": [seller]},
        {"name": "no id", "other_sellers": [seller]},
        "{broken",
    )
    rows, bad = products.seller_rows(docs, "first")
    assert sorted(r.price for r in rows.collect()) == [10, 10, 3_000_001]
    assert {(r.name, r.category, r.brand, r.sales_page) for r in rows.collect()} == {
        ("máy", "c", "b", "first")}
    assert [r.raw for r in bad.collect()] == ["{broken"]


def test_shop_and_item_documents(spark):
    docs = raw(
        spark,
        {"id": 1, "cat_path": "p", "short_description": "🎈🎈x", "price": 5,
         "categories": {"category_level1_name": "c1"}, "category": "c2",
         "shop_info": {"shop_id": 9, "shop_name": "s"}},
        {"id": 2, "category": "c2"},
    )
    first, second = products.shop_rows(docs, "second")[0].orderBy("pid").collect()
    assert (first.url_path, first.short_desc, first.category, first.store_id) == ("p", "x", "c1", 9)
    assert (second.category, second.short_desc, second.store_id) == ("c2", None, None)
    items, bad = products.item_rows(
        raw(spark, {"item": {"itemid": 7, "name": "n", "price": 250000}}, "nothing"),
        "third", "https://shop.example",
    )
    row = items.first()
    assert (row.product_id, row.price, row.url_path) == (7, 2.5, None)
    assert bad.count() == 1


def test_union_and_nested_text(spark):
    a = spark.createDataFrame([(1, "x")], "pid long, brand string")
    b = spark.createDataFrame([(2,)], "pid long")
    assert sorted(map(tuple, products.union_products(a, b).collect())) == [(1, "x"), (2, None)]
    numbers = T.StructType.fromDDL("data array<struct<id:long>>")
    good, _ = parse(raw(spark, {"data": [{"id": 1}]}), "raw", numbers)
    flat = nested_as_text(good.select(F.col("doc.data").alias("badges")))
    assert flat.first()[0] == '[{"id":1}]'


def test_listing_stops_at_the_first_bad_page(spark):
    rows = [
        ("a", 1, 200, '{"data":[{"id":1},{"id":2}]}'), ("a", 2, 200, "{}"),
        ("a", 3, 200, '{"data":[{"id":3}]}'),
        ("b", 1, 200, '{"data":[{"id":4}]}'), ("b", 2, 500, '{"data":[{"id":5}]}'),
        ("c", 1, 200, '{"data":[]}'), ("d", 1, 200, '{"data":[{"id":6}]}'),
    ]
    df = spark.createDataFrame(rows, "listing string, page int, status int, body string")
    got = {(r.listing, r.product_id) for r in products.listing_ids(df).collect()}
    assert got == {("a", "1"), ("a", "2"), ("b", "4"), ("d", "6")}
    assert products.responses_ok(df).count() == 6


def test_ids_as_text_and_broken_prices(spark):
    df = spark.createDataFrame([("a", 1, 200, '{"data":[{"id":"6"},{"id":7}]}')],
                               "listing string, page int, status int, body string")
    assert [r.product_id for r in products.listing_ids(df).collect()] == ["6", "7"]
    sellers = [{"product_id": "11", "price": 5.5, "store_id": 1, "name": "s"},
               {"product_id": 12, "price": 7, "store_id": "x", "name": "t"}]
    rows, bad = products.seller_rows(raw(
        spark, {"id": "3", "other_sellers": sellers}, {"id": "", "other_sellers": sellers},
        {"id": 0, "other_sellers": sellers}), "v")
    assert bad.count() == 0
    assert [(r.pid, r.price, r.store_id) for r in rows.collect()] == [(11, 5, 1), (12, 7, None)]


def test_link_forms(spark):
    html = """<a href='/a'>1</a><a data-href="/no" href="/b?x=1&amp;y=2">2</a><a class=k href=/c>3</a>
        <!-- <a href="/gone"> --><script>var a = '<a href="/js">';</script><A HREF = "/D">4</A>
        <a title="a > b" href="/e">5</a><abbr href="/x">6</abbr><a name="n">7</a>"""
    pages = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id long, html string")
    got = [r.href for r in products.links(pages).orderBy("position").collect()]
    assert got == ["/a", "/b?x=1&y=2", "/c", "/D", "/e"]


def test_links_and_keys(spark):
    html = '<div><a class="c" href="/x-i.1.2">x</a><A HREF = "/y">y</A><a name="q">z</a></div>'
    df = spark.createDataFrame([(1, html)], "page_id long, html string")
    links = products.links(df)
    assert [r.href for r in links.orderBy("position").collect()] == ["/x-i.1.2", "/y"]
    good, bad = products.product_keys(links)
    assert [(r.shop_id, r.item_id) for r in good.collect()] == [("1", "2")]
    assert [r.href for r in bad.collect()] == ["/y"]


PAGE = """<div class="page-product__breadcrumb"><a>Not</a></div><div class="product-detail
page-product__detail"><div><div><div><div><a>No</a></div></div></div><p></p><div><div><label>Where</label>
<div><a>Home</a><img><a>Phones</a></div></div></div></div>
<div><div>Head</div><div><div><b>!</b><span>Long</span></div></div></div></div>
<div class="qaNIZv"><span>Điện &amp; thoại</span></div><div class="_3Lybjn">Shop<br>x</div>
<div class="_3n5NQx">100</div><div class="page-product__detail"><span>Other</span></div>
<div class="kIo6pj"><label>Thương hiệu</label><a>Acme</a></div>
<div class="kIo6pj"><label>Kho</label><div>5</div></div>
<div class="kIo6pj"><label>Kho</label><div>6</div></div>"""


def test_page_records(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "")], "page_id long, html string")
    first, second = pages.page_records(df).orderBy("page_id").collect()
    assert first.title == "Điện & thoại"
    assert (first.store, first.price, first.brand) == ("Shop", "100", "Acme")
    assert first.categories == ["Home", "Phones"] and first.description == "Long"
    assert first.attributes == {"Kho": "6"}
    assert second.title is None and second.attributes == {}
    content = pages.full_content(pages.page_records(df)).orderBy("page_id").first().content
    assert content["Kho"] == "6" and content["brand"] == "Acme"


def test_csv_and_text_round_trips(spark, tmp_path):
    rows = spark.createDataFrame(
        [(3, "c"), (1, "a"), (2, None)], "product_id long, product_title string"
    )
    path = str(tmp_path / "csv")
    tables.write_csv(rows, path, schemas.LABELLED_PRODUCT, required="product_title")
    back = tables.read_csv(spark, path, schemas.LABELLED_PRODUCT, key="product_id", first=1)
    assert back.columns == schemas.LABELLED_PRODUCT.names
    assert [(r.product_id, r.vendor_id) for r in back.collect()] == [(1, None)]
    inferred = tables.read_csv(spark, path, columns=["product_id"])
    assert sorted(r[0] for r in inferred.collect()) == [1, 3]

    lines = str(tmp_path / "ids")
    for _ in range(2):  # replaces, never appends
        tables.write_lines(rows, "product_id", lines)
    assert sorted(r.raw for r in tables.read_documents(spark, lines).collect()) == ["1", "2", "3"]

    out = str(tmp_path / "json")
    for _ in range(2):
        tables.append_json(spark.createDataFrame([("é",)], "t string"), out)
    assert [r.value for r in spark.read.text(out).collect()] == ['{"t":"é"}'] * 2


def test_replace_and_append_follow_the_declared_schema(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([("1", "x")], "pid string, name string")
    tables.replace_table(rows, path, schemas.PRODUCT)
    tables.replace_table(rows, path, schemas.PRODUCT)
    tables.append_rows(rows, path, schemas.PRODUCT)
    back = spark.read.parquet(path)
    assert back.count() == 2 and [f.dataType for f in back.schema] == [
        f.dataType for f in schemas.PRODUCT]


def test_keyed_update(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id long, n string, v long")
    updates = spark.createDataFrame([(2, None, 9, 5), (3, "z", 1, 1)],
                                    "id long, n string, v long, extra long")
    got = tables.keyed_update(target, updates, "id").orderBy("id").collect()
    assert list(map(tuple, got)) == [(1, "a", 1, None), (2, "b", 9, 5)]
    twice = updates.unionByName(updates)
    with pytest.raises(PySparkException):
        tables.keyed_update(target, twice, "id").collect()


def test_numbering_without_one_big_window(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = number_rows(df, ["k"]).collect()
    assert all(r.number == r.k + 1 for r in got) and len(got) == 1000
    assert number_rows(df.limit(0), ["k"]).count() == 0


def test_selection(spark):
    rows = [(i, i % 3 if i < 30 else 9, None if i == 31 else i) for i in range(33)]
    df = spark.createDataFrame(rows, "id long, g long, x long")
    assert {r.g for r in selection.in_large_groups(df, "g", "x", 3).collect()} == {0, 1, 2}
    drawn = selection.sample_groups(df, "g", 5, 2, selection.group_draw(F.col("g"), 1), "id")
    assert drawn.count() == 20
    assert selection.sample_rows(df, 4, selection.random_draw(1), "id").count() == 4
    counts = [tuple(r) for r in selection.value_counts(df, "g").collect()]
    assert counts == [(9, 3), (2, 10), (1, 10), (0, 10)]
    parts = selection.member_lists(df, "g", "id", chunk=4).collect()
    assert sorted(i for r in parts for i in r.members) == list(range(33))
    assert max(len(r.members) for r in parts) <= 10


def test_numbers_over_many_parts(spark):
    # A third of all rows are in one group, many keys are equal or missing.
    rows = [(i % 3 and i % 40, None if i % 7 == 0 else i % 50, i) for i in range(1500)]
    df = spark.createDataFrame(rows, "g long, k long, id long").repartition(6)
    got = number_rows(df, ["g", "k", "id"], rows=40).collect()
    order = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert {r.id: r.number for r in got} == {r[2]: n for n, r in enumerate(order, 1)}
    within = number_within(df, "g", ["k", "id"], rows=40).collect()
    seen = {}
    for g, _, i in order:
        seen[i] = seen[g, "n"] = seen.get((g, "n"), 0) + 1
    assert all(r.number == seen[r.id] for r in within) and len(within) == len(rows)
    equal = number_within(df.select("g", F.lit(1).alias("k")), "g", ["k"], rows=40)
    assert equal.groupBy("g").agg(F.countDistinct("number").alias("n"), F.max("number").alias("m"),
                                  F.count("*").alias("c")).filter("n <> m OR m <> c").count() == 0


def test_sizes_run_over_blocks_of_parts(spark, monkeypatch):
    monkeypatch.setattr("twinshelf.operators.ordering.SIZES", 4)
    df = spark.range(900).repartition(5)
    got = number_rows(df, ["id"], rows=30).collect()
    assert all(r.number == r.id + 1 for r in got) and len(got) == 900


def test_a_local_work_folder_is_refused_on_a_cluster():
    def on(master, **settings):
        conf = SimpleNamespace(get=lambda name, default=None: settings.get(name.replace(".", "_"), default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    warehouse = {"spark_sql_warehouse_dir": "file:/home/x/spark-warehouse"}
    assert session.work_folder(on("local[8]", **warehouse)) == "file:/home/x/spark-warehouse/_work"
    with pytest.raises(ValueError):
        session.work_folder(on("spark://host:7077", **warehouse))
    shared = {"spark_sql_warehouse_dir": "hdfs://store/warehouse"}
    assert session.work_folder(on("yarn", **shared)) == "hdfs://store/warehouse/_work"
    assert session.work_folder(on("yarn", spark_checkpoint_dir="/shared/c/")) == "/shared/c"


def test_staged_tables_are_released_whole_or_in_part(spark):
    df = spark.createDataFrame([(1, True), (2, False)], "id long, kept boolean")
    staged, n = session.counted_stage(df, "parts", F.col("kept"), "kept")
    assert n == 1 and staged.count() == 2
    session.release(staged, "kept=false")
    assert [r.id for r in spark.read.parquet(staged.staged_at).collect()] == [1]
    empty = session.stage(df.limit(0), "empty")
    folder = spark._jvm.org.apache.hadoop.fs.Path(empty.staged_at)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.exists(folder)
    session.release(empty)
    assert not files.exists(folder)


def test_selected_products_are_written_before_they_are_sorted(spark):
    rows = spark.createDataFrame(
        [(1, 5, "SMALL", "x"), (2, 9, "SMALL", "x"), (3, 1, "SMALL", "x"), (4, 7, "LARGE", "x")],
        "pid long, price long, category string, brand string")
    found = products.priced(rows, floor=2, category="SMALL")
    assert "priced-" in found._jdf.queryExecution().toString()
    assert [r.pid for r in found.collect()] == [2, 1]
