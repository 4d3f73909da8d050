import random

from llm_frames import awkward, documents, nothing
from pyspark.sql import functions as F

from wattline.llm import mixing


def plan(spark, sizes, **options):
    frame = spark.createDataFrame(sizes, "source string, source_size long")
    return {r.source: r for r in mixing.targets(frame, **options).collect()}


def filled(sizes, cycle=(5, 2, 1), cap=3):
    """Targets by raising the common level until nobody is above the cap."""
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    full = set()
    while True:
        open_ = [s for s in sizes if s not in full]
        if not open_:
            return {s: cap * sizes[s] for s in sizes}
        level = (sum(sizes.values()) - sum(cap * sizes[s] for s in full)) / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] >= cap * sizes[s]}
        if not over:
            return {s: cap * sizes[s] if s in full else level * weight[s] for s in sizes}
        full |= over


def test_targets_equal_filling_by_level(spark):
    draw = random.Random(3)
    for n in (1, 2, 5, 9):
        sizes = {f"s{i}": draw.choice([0, 1, 10, 1000, 50_000]) for i in range(n)} | {None: 7}
        found, wanted = plan(spark, list(sizes.items())), filled(sizes)
        for s, t in wanted.items():
            assert abs(found[s].target - t) < 1e-6 * max(1, t), (sizes, s)
        assert abs(sum(r.target for r in found.values()) - sum(sizes.values())) < 1e-3


def taken(spark, docs, **options):
    rows = mixing.keyed(docs)
    narrow = rows.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "key", "tie").cache()
    return mixing.decide(narrow, mixing.cuts(narrow, **options)).collect()


def test_takes_whole_epochs_and_a_prefix_in_key_order(spark):
    draw = random.Random(5)
    docs = [(i, "word " * draw.randint(0, 60), draw.choice(["a", "b", "b", "b", "c", None])) for i in range(900)]
    for cell_rows in (40, 10_000):
        found = taken(spark, documents(spark, docs), cell_rows=cell_rows)
        for source in {"a", "b", "c", None}:
            mine = sorted((r for r in found if r.source == source), key=lambda r: (r.key, r.tie))
            target, size = mine[0].target, mine[0].source_size
            epochs, upto = int(target // size), 0
            for r in mine:
                upto += r.size
                assert r.copies == epochs + (2 * upto - r.size <= 2 * (target - epochs * size))
            assert abs(sum(r.size * r.copies for r in mine) - target) <= max(r.size for r in mine)


def test_better_documents_come_more_often(spark):
    docs = [(i, ("good text here " if i % 2 else "#### %%%% 1 a ") * 5, "b" if i < 400 else "a") for i in range(800)]
    found = taken(spark, documents(spark, docs))
    extra = [r.doc_id % 2 for r in found if r.source == "b" and r.copies == max(x.copies for x in found if x.source == "b")]
    assert sum(extra) > 0.6 * len(extra)


def test_partitions_do_not_matter(spark):
    docs = documents(spark, [(i, "w " * (i % 17), "ab"[i % 2]) for i in range(300)])
    key = lambda rows: sorted((r.doc_id, r.copies) for r in rows)
    assert key(taken(spark, docs.repartition(1))) == key(taken(spark, docs.repartition(7)))


def test_awkward_rows(spark):
    docs = awkward(spark)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert {r.row for r in out.collect()} == {"own row"}
    repeated = [r.copies for r in taken(spark, docs) if r.doc_id == 5]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    empty = mixing.mix(nothing(spark))
    assert empty.columns == docs.columns and empty.count() == 0


def test_word_count(spark):
    texts = [None, "", " \t\n", "a", " a\x0bb\x0cc ", "a\xa0b  "]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in frame.select(mixing.word_count(F.col("t"))).collect()] == [0, 0, 0, 1, 3, 2]
