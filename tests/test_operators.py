import random

from pyspark.sql import functions as F

from leafwork.operators import describe, measure, pages, placement, registry, rendering, routing, units


def test_latest_and_blocks(spark, rows):
    data = [("a", 1, "Page", [("text", "x", None), ("image", None, 3)], None), ("a", 1, "Page", [("text", "x", None), ("image", None, 3)], "2024-01-01 00:00:00"), ("a", 2, "Page", None, None), ("a", 3, "Page", [], None)]
    df = spark.createDataFrame(data, "doc_id string, number int, unit_kind string, blocks array<struct<kind:string,text:string,image_id:int>>, scanned_at string").withColumn("scanned_at", F.col("scanned_at").cast("timestamp"))
    u = units.units(df)
    assert u.count() == 3
    assert rows(units.blocks(u)) == sorted([("a", 1, 1, "text", "x", None), ("a", 1, 2, "image", None, 3)], key=repr)
    assert units.units(df.where("false")).count() == 0
    assert rows(units.number_units(u)) == [("a", 1, 1), ("a", 2, 2), ("a", 3, 3)]


def test_tree_order_keeps_groups_together(spark):
    p = lambda *s: [dict(zip(("top", "left", "ord"), x, strict=True)) for x in s]
    data = [("d", "late child", p((5, 0, 0), (0, 0, 1))), ("d", "first", p((1, 0, 1))), ("d", "between", p((6, 0, 2))), ("d", "child far down", p((5, 0, 0), (99, 0, 0))), ("d", "tie b", p((1, 0, 3)))]
    df = spark.createDataFrame(data, "doc string, name string, sort_path array<struct<top:bigint,left:bigint,ord:int>>")
    got = [r.name for r in units.tree_order(df, ["doc"]).orderBy("rank").select("name").collect()]
    assert [r for r in got] == ["first", "tie b", "late child", "child far down", "between"]


def test_shape_blocks(spark):
    data = [("d", 1, " t ", None, b"x", "png"), ("d", 2, " t ", [["a ", ""], ["", " "]], None, None), ("d", 3, None, None, None, None)]
    df = spark.createDataFrame(data, "doc string, rank bigint, text string, rows array<array<string>>, blob binary, ext string")
    notes = spark.createDataFrame([("d", " n "), ("e", " ")], "doc string, notes string")
    got = [(r.pos, r.kind, r.text) for r in units.shape_blocks(df, ["doc"], notes=notes).orderBy("pos").collect()]
    assert got == [(1, "image", None), (2, "text", "t"), (3, "text", "a | "), (4, "text", "**Speaker notes:** n")]


def test_registry_first_seen(spark):
    data = [("d", 2, "B", "page"), ("d", 1, "A", "figure"), ("d", 3, "A", "page"), ("d", 4, None, "figure"), ("e", 1, "B", "figure")]
    df = registry.register(spark.createDataFrame(data, "doc string, seq int, digest string, kind string"), "doc", "digest", "seq")
    assert {(r.doc, r.seq): r.image_id for r in df.collect()} == {("d", 1): 1, ("d", 2): 2, ("d", 3): 1, ("d", 4): None, ("e", 1): 1}
    first = {(r.doc, r.image_id): r.kind for r in registry.unique(df, "doc", "digest", ["kind"], "seq").collect()}
    assert first == {("d", 1): "figure", ("d", 2): "page", ("e", 1): "figure"}
    assert {r.doc: (r.refs, r.unique_images, r.deduped) for r in registry.parse_stats(df, "doc", "digest").collect()} == {"d": (3, 2, 1), "e": (1, 1, 0)}


def test_route_boundaries(spark):
    data = [("a", 29.0, 46, 0), ("b", 30.0, 46, 0), ("c", 29.0, 45, 0), ("d", 4.9, 11, 0), ("e", 4.9, 10, 0), ("f", 5.0, 11, 0), ("g", 99.0, 0, 2), ("h", 99.0, 0, 1), ("i", 0.0, 99, 0)]
    df = spark.createDataFrame([(k, t, p, g, 0.0 if k == "i" else 100.0) for k, t, p, g in data], "k string, text_score double, pic_area bigint, graphic_shapes bigint, area double")
    assert {r.k: r.route for r in routing.route(df, "area").collect()} == {"a": "vision", "b": "text", "c": "text", "d": "vision", "e": "text", "f": "text", "g": "vision", "h": "text", "i": "text"}
    routes = spark.createDataFrame([("x", "vision"), ("x", "text"), ("y", "text"), ("z", "vision"), ("z", "text"), ("z", "text")], "doc_id string, route string")
    assert {r.doc_id: r.mode for r in routing.deck_mode(routes, page="route").collect()} == {"x": "whole", "y": "routed", "z": "routed"}


def test_placement_equals_sequential_rule(spark):
    rng = random.Random(5)
    figures, slides, want = [], [], {}
    for d in range(150):
        valid = sorted(rng.sample(range(1, 30), rng.randint(1, 6)))
        slides += [(d, n) for n in valid]
        prev = valid[0]
        for f in range(rng.randint(1, 8)):
            reply = rng.choice([None, rng.randint(-3, 40)])
            figures.append((d, f, reply))
            target = min(max(prev if reply is None else reply, prev), valid[-1])
            prev = next(n for n in valid if n >= target)
            want[d, f] = prev
    got = placement.place(spark.createDataFrame(figures, "doc_id int, figure int, reply int"), spark.createDataFrame(slides, "doc_id int, number int"))
    assert {(r.doc_id, r.figure): r.slide for r in got.collect()} == want


def test_consume_equals_sequential_model(spark):
    rng = random.Random(9)
    pairs, want = [], []
    for d in range(120):
        mine = sorted({(n := rng.randint(1, 4), rng.randint(0, 2), n + 1, rng.randint(0, 2)) for _ in range(rng.randint(1, 7))})
        seen = {}
        for p in mine:
            seen.setdefault(p[:2], p)
        mine = sorted(seen.values())
        pairs += [(d, *p) for p in mine]
        used = set()
        for p in mine:
            if p[:2] not in used and p[2:] not in used:
                used |= {p[:2], p[2:]}
                want.append((d, *p))
    got = pages.consume(spark.createDataFrame(pairs, "doc_id int, n int, i int, m int, j int"))
    assert sorted(map(tuple, got.collect())) == want


def test_page_edges(spark):
    sheet = spark.createDataFrame([("d", p, 100.0, 100.0) for p in (1, 2, 3, 4)], "doc_id string, page int, width double, height double")
    boxes = [("d", 1, 0, 10.0, 50.0, 60.0, 94.0, 50, 44), ("d", 2, 0, 15.0, 6.0, 65.0, 30.0, 50, 24), ("d", 3, 0, 0.0, 0.0, 100.0, 60.0, 100, 60), ("d", 4, 0, 0.0, 10.0, 10.0, 20.0, 63, 90)]
    images = spark.createDataFrame(boxes, "doc_id string, page int, idx int, x0 double, y0 double, x1 double, y1 double, w bigint, h bigint")
    texts = spark.createDataFrame([("d", 3, 0, 0.0, 0.0, "x" * 20), ("d", 4, 0, 0.0, 0.0, "x" * 21)], "doc_id string, page int, idx int, x0 double, y0 double, text string")
    marks = {r.page: (r.scanned, r.empty) for r in pages.classify(sheet, texts, images).collect()}
    assert marks == {1: (False, False), 2: (False, False), 3: (True, False), 4: (False, False)}
    flat = images.where("page <> 3")
    assert [tuple(r) for r in pages.split_pairs(flat, sheet).collect()] == [("d", 1, 0, 2, 0)]
    got = {(r.page, r.kind, r.ref) for r in pages.assemble(sheet, texts, images).collect()}
    assert got == {(1, "stitched", 0), (3, "page", 0), (4, "text", 0)}
    assert pages.assemble(sheet.where("false"), texts.where("false"), images.where("false")).count() == 0


def test_stitched_height_is_half_even(spark):
    images = spark.createDataFrame([("d", 1, 0, 0.0, 0.0, 1.0, 1.0, 4, 5), ("d", 2, 0, 0.0, 0.0, 1.0, 1.0, 2, 1), ("d", 3, 0, 0.0, 0.0, 1.0, 1.0, 10, 1)], "doc_id string, page int, idx int, x0 double, y0 double, x1 double, y1 double, w bigint, h bigint")
    kept = spark.createDataFrame([("d", 1, 0, 2, 0), ("d", 1, 0, 3, 0)], "doc_id string, n int, i int, m int, j int")
    assert {r.m: (r.w, r.h) for r in pages.stitched(images, kept).collect()} == {2: (4, 7), 3: (10, 13)}


def test_render(spark):
    u = spark.createDataFrame([("d", 1), ("d", 2)], "doc_id string, number int")
    b = spark.createDataFrame([("d", 1, 1, "text", "A & <b>", None), ("d", 1, 2, "image", None, 7)], "doc_id string, number int, pos int, kind string, text string, image_id int")
    spliced = rendering.splice(b, spark.createDataFrame([("d", 7, "")], "doc_id string, image_id int, description string"), ["description"])
    parts = spliced.select("doc_id", "number", "pos", rendering.deck_part(F.lit(True)).alias("part"))
    body = rendering.document_texts(rendering.unit_texts(u, parts, F.concat(F.lit("Slide "), F.col("number").cast("string"))))
    xml = body.select(rendering.xml_file(rendering.xml_document(F.lit(1), F.lit('a"b'), F.lit("PPT"), F.col("body")))).first()[0]
    assert xml == '<documents>\n  <document index="1" filename="a&quot;b" data-type="PPT">\nSlide 1\n\nA & <b>\n\n[Image 7 (approximate slide)]\n(no description)\n\nSlide 2\n  </document>\n</documents>\n'


def test_describe_once_for_each_picture(spark, tmp_path):
    log = str(tmp_path)

    def slow(blob, ext):
        import os
        import uuid

        open(os.path.join(log, uuid.uuid4().hex), "w").close()
        if blob == b"bad":
            raise ValueError("broken")
        return f"{ext}:{len(blob)}"

    data = [(1, "A", b"xx", "png"), (2, "A", b"xx", "png"), (3, "B", b"bad", "gif"), (4, None, None, "png")]
    df = spark.createDataFrame(data, "k int, digest string, blob binary, ext string")
    got = {r.k: r.description for r in describe.describe(df, figure=slow).collect()}
    assert got == {1: "png:2", 2: "png:2", 3: "[image description failed: broken]", 4: None}
    assert len(list(tmp_path.iterdir())) == 2


def test_recall_and_tallies(spark, rows):
    r = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, token string")
    o = spark.createDataFrame([(1, "a"), (3, "c")], "k int, token string")
    assert rows(measure.recall(r, o, ["k"])) == [(1, 2, 1, 50.0), (2, 1, 0, 0.0)]
    one = spark.createDataFrame([([], ["a"]), (["a", "b"], ["b"])], "a array<string>, b array<string>")
    assert [x[0] for x in one.select(measure.recall_of(F.col("a"), F.col("b"))).collect()] == [0.0, 50.0]
    calls = spark.createDataFrame([("x", 1, None), ("x", 2, 3)], "approach string, input_tokens bigint, output_tokens bigint")
    assert rows(measure.tally(calls, ["approach"])) == [("x", 2, 3, 3)]


def test_latest_does_not_hang_on_the_order_of_rows(spark):
    data = [("k", None, "x", None), ("k", None, "y", "a"), ("k", None, "y", "b"), ("j", 2, "old", "z"), ("j", 3, "new", "c"), ("j", None, "none", "q"), (None, 1, "n", "n")]
    for rows in (data, data[::-1]):
        df = spark.createDataFrame(rows, "key string, at int, v string, w string")
        assert {(r.key, r.v, r.w) for r in units.latest(df, ["key"], "at").collect()} == {("k", "y", "b"), ("j", "new", "c"), (None, "n", "n")}
        assert units.latest(df, ["key"], "at", ["v"]).columns == ["key", "v"]


def test_many_pairs_of_one_document_fold_in_one_pass(spark):
    """A chain over 200,000 pages: every second pair is kept; two tops for one bottom: the first."""
    from leafwork.operators import pages as P

    chain = spark.range(200_000).selectExpr("'d' AS doc_id", "cast(id AS int) AS n", "0 AS i", "cast(id + 1 AS int) AS m", "0 AS j")
    assert P.consume(chain).selectExpr("count(*)", "sum(n % 2)").first() == (100_000, 0)
    df = spark.createDataFrame([("e", 1, 0, 2, 5), ("e", 1, 1, 2, 5), ("e", 2, 5, 3, 0), ("e", 3, 0, 4, 0), ("f", 2, 5, 3, 0), (None, 7, 0, 8, 0), (None, 8, 0, 9, 0)], "doc_id string, n int, i int, m int, j int")
    assert {tuple(r) for r in P.consume(df).collect()} == {("e", 1, 0, 2, 5), ("e", 3, 0, 4, 0), ("f", 2, 5, 3, 0), (None, 7, 0, 8, 0)}


def test_numbers_in_groups_of_any_size(spark):
    df = spark.range(5000).selectExpr("if(id % 10 = 0, if(id % 20 = 0, 'b', cast(null AS string)), 'a') AS g", "cast(5000 - id AS string) AS v")
    got = units.numbered(df, "g", ["v"], "n").collect()
    for g in ("a", "b", None):
        mine = sorted((r.v, r.n) for r in got if r.g == g)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))
    assert units.numbered(df.where("false"), "g", ["v"], "n").count() == 0
