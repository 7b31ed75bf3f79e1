import re

import pytest

from tidewater.functions.ids import ENTITY_PREFIXES, id_pattern, with_entity_id


@pytest.mark.parametrize("entity", sorted(ENTITY_PREFIXES))
def test_ids_shape_and_distinct(spark, entity):
    df = with_entity_id(spark.range(2000), entity)
    ids = [r.id for r in df.collect()]
    assert len(set(ids)) == 2000
    assert all(re.fullmatch(id_pattern(entity), i) and len(i) == 36 for i in ids)


def test_deterministic_ids_repeat_and_separate_nulls(spark):
    df = spark.createDataFrame([(1, None), (None, 1), (1, 1)], "a int, b int")
    a = [r.id for r in with_entity_id(df, "brand", deterministic_from=["a", "b"]).collect()]
    b = [r.id for r in with_entity_id(df.repartition(3), "brand", deterministic_from=["a", "b"]).orderBy("a", "b").collect()]
    assert len(set(a)) == 3 and sorted(a) == sorted(b)


def test_stable_ids_survive_recompute(spark):
    df = with_entity_id(spark.range(100), "area", stable=True)
    first = {r.id for r in df.collect()}
    assert first == {r.id for r in df.collect()}


def test_unknown_entity(spark):
    with pytest.raises(ValueError):
        with_entity_id(spark.range(1), "planet")
