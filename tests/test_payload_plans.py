import json

import pytest
from pyspark.sql import functions as F

from vernissage.functions import payload
from vernissage.functions.scalars import plain_text, to_money
from vernissage.operators.dedup import SortField
from vernissage.plans import pages

from .conftest import SF, rows, utc


@pytest.mark.parametrize(
    "text, expected",
    [
        ("{a: 1, 'b': [true, null, undefined, void 0], c: \"x\\u00e9\\n\"}", {"a": 1, "b": [True, None, None, None], "c": "xé\n"}),
        ("[new Date(5), -1.5e3, .5]", [5, -1500.0, 0.5]), ("{}", {}), ("[1,]", [1]), ("{a:}", None), ("{", None), ("", None), (None, None), ("nonsense", None), ("[" * 500, None),
    ],
)
def test_literals(text, expected):
    assert payload.parse_literal(text) == expected


def test_balanced():
    assert payload.balanced('x = {"a": "}", b: \'{\', c: [1]} tail', 4) == '{"a": "}", b: \'{\', c: [1]}'
    assert payload.balanced("{[}", 0) is None and payload.balanced("", 0) is None


def test_references_with_cycle():
    assert payload.resolve_references([{"a": 1, "b": 2, "me": 0}, ["Date", "2025-01-01"], [3, 3], "x"]) == {"a": "2025-01-01", "b": ["x", "x"], "me": None}
    assert payload.resolve_references([["Reactive", 1], {"k": 2}, 5]) == {"k": 5}
    assert payload.resolve_references([]) is None


def test_references_used_many_times_are_resolved_once():
    import time

    began = time.perf_counter()
    levels = [[i + 1, i + 1] for i in range(18)] + ["leaf"]
    out = payload.resolve_references(levels)
    assert time.perf_counter() - began < 0.5 and out[0] is out[1]
    with pytest.raises(ValueError, match="too large"):
        payload.resolve_references([[i + 1, i + 1] for i in range(60)] + ["leaf"])


def test_members_that_are_no_index_stand_for_themselves():
    table = [{"a": "x", "b": True, "c": 1, "d": -1, "e": 99, "f": None}, {"g": 2, "up": 0}, 7]
    assert payload.resolve_references(table) == {"a": "x", "b": True, "c": {"g": 7, "up": None}, "d": None, "e": None, "f": None}


def test_linked_objects():
    store = {"Q": {"lot": {"__ref": "L1"}, "more": [{"__ref": "L2"}, {"__ref": "gone"}]}, "L1": {"id": 1, "sale": {"__ref": "S"}}, "L2": {"id": 2}, "S": {"lots": [{"__ref": "L1"}]}}
    assert payload.linked_objects(store, "Q") == {"lot": {"id": 1, "sale": {"lots": [{"__ref": "L1"}]}}, "more": [{"id": 2}, {"__ref": "gone"}]}
    assert payload.linked_objects(store, "none") is None


@pytest.mark.parametrize(
    "chunks, expected",
    [(['{"lot" : {"a": 1}}'], '{"a": 1}'), (['"lot":\n\t{ "b": "}" }'], '{ "b": "}" }'), (['"lot": null, "lot": [1], "lot": {"c"', ": 2}"], '{"c": 2}'), (['"lot": {broken}, "lot": {}'], "{}"), (['"lots": {}'], None), ([None], None), ([], None)],
)
def test_object_after_a_key(spark, chunks, expected):
    df = spark.createDataFrame([(chunks,), (None,)], "c array<string>")
    assert [r.v for r in df.select(payload.object_after("lot")("c").alias("v")).collect()] == [expected, None]


def test_pairs_and_paths_of_any_length(one):
    far = "LOT" + " " * 50_000 + '"a":"1","a":"2","b":"x\\"y"'
    assert one(payload.pairs_after("s", "LOT"), "s string", far) == {"a": "1", "b": 'x\\"y'}
    deep = '{"k":' * 30 + '"v"' + "}" * 30
    assert [tuple(x) for x in one(payload.leaf_paths("s"), "s string", deep)] == [(".".join("k" * 30), '"v"')]
    assert [tuple(x) for x in one(payload.leaf_paths("s"), "s string", '{"a": [], "b": {}, "c": "' + "x" * 200 + '"}')] == [("a", "[]"), ("b", "{}"), ("c", '"' + "x" * 200 + '"')]


def test_very_long_strings_in_scripts(spark):
    inner = json.dumps({"k": ['a"b\\n'] * 100_000})
    html = f"self.__next_f.push([1,{json.dumps(inner)}]) LOT " + '"a":"' + 'x\\"' * 100_000 + '"'
    df = spark.createDataFrame([(html, f"v = {json.dumps(inner)};"), ("f.push([1,\"open", "v = open"), (None, None)], "h string, v string")
    got = df.select(F.length(F.get(payload.flight_chunks("h"), 0)).alias("c"), F.length(payload.string_after("v = ")("v")).alias("s"), F.length(payload.pairs_after("h", "LOT")["a"]).alias("p")).collect()
    assert [tuple(r) for r in got] == [(len(inner), len(inner), 300_000), (None, None, None), (None, None, None)]


def test_scripts_metas_and_chunks(one, spark):
    html = '<script type="application/json" id="__D__">{"a": {"b": [1, 2]}}</script><script type="application/ld+json">{"@type": "X"}</script><meta content="10" property="og:price"><script>f.push([1,"x\\"y"])</script>'
    assert one(F.try_variant_get(payload.script_json("s", "__D__"), "$.a.b[1]", "int"), "s string", html) == 2
    assert one(payload.script_json("s", "none").isNull(), "s string", html) is True
    assert one(payload.script_json("s", "b").isNull(), "s string", '<script id="b">{bad</script>') is True
    assert one(payload.jsonld_blocks("s"), "s string", html) == ['{"@type": "X"}']
    assert one(payload.meta_content("s", "og:price"), "s string", html) == "10"
    assert one(payload.flight_chunks("s"), "s string", html) == ['x"y']
    assert one(payload.pairs_after("s", "LOT"), "s string", '"a":"0" LOT "a":"1","b":"2","a":"3"') == {"a": "1", "b": "2"}
    assert one(payload.pairs_after("s", "LOT"), "s string", "none") is None
    df = spark.createDataFrame([("window.x = {k: '}'}; y",), ("nothing",), (None,)], "s string")
    assert [r.v for r in df.select(payload.assigned_udf("window.x")("s").alias("v")).collect()] == ['{"k": "}"}', None, None]
    df = spark.createDataFrame([(json.dumps([{"a": 1}, "v"]),), ("bad",), (None,)], "s string")
    assert [r.v for r in df.select(payload.resolved_json("s").alias("v")).collect()] == ['{"a": "v"}', None, None]
    assert [tuple(x) for x in one(payload.leaf_paths("s"), "s string", '{"a": [{"b": 1}], "c": null}')] == [("a[].b", "1"), ("c", "null")]


def test_jsonld_lists_graphs_and_types(spark):
    block = lambda x: f'<script type="application/ld+json">{x}</script>'
    html = block('[{"@type": "A", "n": 1}, {"@type": ["B", "C"], "n": 2}]') + block("{broken") + block('{"@graph": [{"@type": "D", "n": 3}]}') + block('{"@type": "A", "n": 4}')
    df = spark.createDataFrame([(html,), ("none",), (None,)], "s string").select(payload.jsonld_objects("s").alias("o"))
    got = df.select(*[F.try_variant_get(payload.first_of_type(F.col("o"), t), "$.n", "int").alias(t) for t in "ACDX"], F.size("o").alias("n")).collect()
    assert tuple(got[0]) == (1, 2, 3, None, 4) and tuple(got[1]) == (None, None, None, None, 0)


def test_twice_encoded_and_keyed_objects(spark):
    inner = json.dumps({"a": [1, {"b": "}"}]})
    html = f'<script id="r">{json.dumps(inner)}</script>'
    df = spark.createDataFrame([(html, ['x"lot":1,"lot":', '{"id":7,"t":"}"} rest']), ("", None)], "s string, c array<string>")
    got = df.select(F.try_variant_get(payload.twice_encoded("s", "r"), "$.a[1].b", "string").alias("b"), payload.object_after("lot")("c").alias("o")).collect()
    assert [tuple(r) for r in got] == [("}", '{"id":7,"t":"}"}'), (None, None)]


def test_cards(spark):
    html = '<div class="card big" data-id="1"><a href="/x"><img src="i.jpg"></a><h3>Ti<b>tle</b> &amp; more</h3><p class="price">9</p><br></div><div class="other">no</div><li class="card"><p class="price">8</p></li><div class="card"><p>'
    df = spark.createDataFrame([(html,), (None,), ("challenge",)], "s string")
    cards = payload.cards_udf("card", {"url": ("a", "href"), "image": ("img", "src"), "title": ("h3", "text"), "price": ("price", "text")})
    got = [r.v for r in df.select(cards("s").alias("v")).collect()]
    assert got[0][:2] == [{"data-id": "1", "url": "/x", "image": "i.jpg", "title": "Title & more", "price": "9"}, {"price": "8"}] and got[1] == [] == got[2]


MAPPING = pages.Mapping(
    payload=lambda h: payload.script_json(h, "d"), rows="$.items", key="platform_artwork_id",
    columns={"platform_artwork_id": ("$.id", "string"), "title": ("$.title", "string"), "price": ("$.price", "string"), "has_detail": ("$.full", "boolean")},
    convert={"price": to_money}, relevant=lambda v: F.try_variant_get(v, "$.kind", "string") == "list",
)


def page(body, kind="list"):
    return f'<script id="d">{json.dumps({"kind": kind, "items": body})}</script>'


def test_pages_to_rows(spark, tmp_path):
    from vernissage.operators.merge import Store

    data = [
        ("a.html", page([{"id": 1, "title": "t", "price": "1,000.5"}, {"id": None}, {"id": "2", "price": "x", "full": True}]), utc(2025, 1, 1)),
        ("b.html", page({"id": "1", "title": "one object", "full": True}), utc(2025, 1, 2)), ("c.html", page([{"id": "9"}], "other"), utc(2025, 1, 1)), ("d.html", "challenge", utc(2025, 1, 1)), ("e.html", None, None),
    ]
    df = spark.createDataFrame(data, "filename string, html string, crawled_at timestamp")
    p = pages.parsed(df, MAPPING)
    assert rows(pages.rejected(p), "filename") == [("d.html",), ("e.html",)]
    store = Store(spark, str(tmp_path), "artworks", "platform_artwork_id", [SortField("has_detail")])
    best = pages.run(df, MAPPING, [SortField("has_detail"), SortField("crawled_at"), SortField("source_file")], "p", "2025-01-03", store)
    assert rows(best, "platform_artwork_id", "title", "price", "source_file") == [("1", "one object", None, "b.html"), ("2", None, None, "a.html")]
    assert store.read("versions").count() == 2
    assert rows(pages.run_stats(p, best)) == [(5, 2, 2)]


def test_a_page_of_a_lot_is_read_once_and_by_all_cores(spark):
    import __spark_entry__

    found = __spark_entry__.queries()["p_lots_sothebys"](spark, SF)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert found.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    cleaned = spark.createDataFrame([("<b>A</b>",)], "s string").select(plain_text("s").alias("t"))
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count("(script|style)") == 1 and cleaned.first()["t"] == "A"


def test_pages_without_a_payload_give_no_rows(spark):
    m = pages.Mapping(lambda html: payload.script_json(html, "S"), "$", "id", {"id": ("$.id", "string")})
    html = ['<script id="S">{"id": "a"}</script>', '<script id="S"></script>', '<script id="S">{broken</script>', "no script", None]
    df = spark.createDataFrame([(str(i), utc(2025, 1, 1), h) for i, h in enumerate(html)], "filename string, crawled_at timestamp, html string")
    assert rows(pages.mapped(pages.parsed(df, m), m), "filename", "id") == [("0", "a")]
    assert pages.rejected(pages.parsed(df, m)).count() == 4
