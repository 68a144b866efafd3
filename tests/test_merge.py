"""First-wins merge by keyed state: any division into batches and runs gives what one batch gives."""

import os
import random
import tempfile

import pytest

from plenaria import vocab
from plenaria.plans.collect import merge_by_term_priority
from plenaria.streaming import merge

SCHEMA = "id_interno string, termo_busca string, ementa string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def land(spark, landing, batch):
    spark.createDataFrame(batch, SCHEMA).coalesce(1).write.mode("append").parquet(landing)


def run(spark, root, lanes=4, files=None):
    reader = spark.readStream.schema(SCHEMA)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    merge.merge_stream(reader.parquet(root + "/landed"), root + "/out", root + "/ckpt", lanes=lanes)


def test_batches_give_what_one_batch_gives(spark):
    rng = random.Random(3)
    found = [*vocab.SEARCH_TERMS[:5], "outro", None]
    records = [(rng.choice(["1", "2", "3", "hot", "hot", None]), rng.choice(found), rng.choice(["b", "a", None, ""])) for _ in range(120)]
    whole = spark.createDataFrame(records, SCHEMA)
    for cuts in ([40, 80], [10]):
        root = tempfile.mkdtemp(prefix="plenaria-merge-")
        parts = [records[a:b] for a, b in zip([0, *cuts], [*cuts, None])]
        land(spark, root + "/landed", parts[0])
        run(spark, root)
        for part in parts[1:]:
            land(spark, root + "/landed", part)
        run(spark, root, files=1)
        assert rows(merge.merged(spark, root + "/out")) == rows(merge_by_term_priority(whole))


def test_only_improvements_are_appended(spark):
    best, worse = vocab.SEARCH_TERMS[0], vocab.SEARCH_TERMS[3]
    root = tempfile.mkdtemp(prefix="plenaria-merge-")
    for batch, held in [([("1", worse, "x"), ("2", best, "x")], 2), ([("1", best, "y"), ("2", worse, "y")], 3),
                        ([("1", worse, "z"), ("1", best, "y"), ("2", best, "x")], 3)]:
        land(spark, root + "/landed", batch)
        run(spark, root, lanes=1)
        assert spark.read.parquet(root + "/out").count() == held
    assert rows(merge.merged(spark, root + "/out")) == [("1", best, "y"), ("2", best, "x")]
    run(spark, root, lanes=1)                                     # nothing new
    assert spark.read.parquet(root + "/out").count() == 3


def test_other_types_are_refused(spark):
    root = tempfile.mkdtemp(prefix="plenaria-merge-")
    os.makedirs(root + "/landed")
    stream = spark.readStream.schema("id_interno string, termo_busca string, n int").parquet(root + "/landed")
    with pytest.raises(ValueError, match="text columns"):
        merge.improvements(stream)


def test_improvements_are_aggregated_without_python_per_id(spark):
    root = tempfile.mkdtemp(prefix="plenaria-merge-")
    os.makedirs(root + "/landed")
    plan = merge.improvements(spark.readStream.schema(SCHEMA).parquet(root + "/landed"))._jdf.queryExecution().analyzed().toString()
    assert "Aggregate [id_interno" in plan and "current_timestamp" in plan and "Pandas" not in plan and "Python" not in plan


def test_a_repeated_batch_replaces_its_rows(spark):
    root = tempfile.mkdtemp(prefix="plenaria-merge-")
    best, worse = vocab.SEARCH_TERMS[0], vocab.SEARCH_TERMS[3]
    for batch in ([("1", worse, "x"), (None, worse, "x")], [("1", best, "y"), (None, worse, "x"), ("2", worse, None)]):
        land(spark, root + "/landed", batch)
        run(spark, root)
    before = rows(spark.read.parquet(root + "/out"))
    assert len(before) == 4
    for name in ("1", ".1.crc"):                                  # as if the driver were lost before the second commit
        os.remove(f"{root}/ckpt/commits/{name}")
    run(spark, root)
    assert rows(spark.read.parquet(root + "/out")) == before
