"""Options of views and prompts: states split, fixed orders, the rubric's scale, categories of the list."""

import pytest
from pyspark.sql import functions as F

from plenaria import vocab
from plenaria.plans import mart, scoring


def test_states_split(spark):
    df = spark.createDataFrame([("SP; RJ", 2.0), ("SP;SP", 4.0), ("—", 1.0), (None, 1.0), ("", 1.0), ("RJ", None)], "uf string, score_lr double")
    assert {tuple(r) for r in mart.by_state(df, explode_states=True).collect()} == {("SP", 2), ("RJ", 2)}
    assert {tuple(r) for r in mart.by_state(df).collect()} == {("SP; RJ", 1), ("SP;SP", 1), ("RJ", 1)}
    assert {tuple(r) for r in mart.ideology_by_state(df, explode_states=True).collect()} == {("SP", 3.0), ("RJ", 2.0)}


def test_fixed_orders(spark):
    df = spark.createDataFrame([("Esquerda", "Sul", "PL"), (None, None, None), ("Outra", "Norte", "PL")],
                               "espectro string, regiao string, tipo string")
    got = {(r["dimensao"], r["valor"]): (r["n"], r["ordem"]) for r in mart.fixed_orders(df).collect()}
    assert got[("espectro", "Esquerda")] == (1, 1) and got[("espectro", vocab.IDEOLOGY_UNKNOWN)] == (1, 6)
    assert got[("espectro", "Outra")] == (1, None) and got[("regiao", None)] == (1, None) and got[("regiao", "Sul")] == (1, 5)
    assert got[("grupo", "Projetos de Lei")] == (2, 1) and got[("grupo", vocab.OTHERS)] == (1, 5)
    assert mart.fixed_orders(df.limit(0)).count() == 0


def prompt(spark, **options):
    return spark.range(1).select(scoring.prompt_text(F.lit("CTX"), **options)).first()[0]


def test_the_scale_is_a_parameter(spark):
    plain, scaled = prompt(spark), prompt(spark, scale=vocab.SCORE_SCALE)
    assert "\n4.5–5.75: " in plain and "\n4.5–5.75: " not in scaled
    changed = [(a, b) for a, b in zip(plain.split("\n"), scaled.split("\n"), strict=True) if a != b]
    assert [b for _, b in changed] == [f"{k.replace('-', '–')}: {v}. Exemplos:" for k, v in vocab.SCORE_SCALE.items()]
    with pytest.raises(ValueError):
        prompt(spark, scale={"0-10": "tudo"})


def test_categories_of_the_list(one_col):
    values = [vocab.CATEGORIES[0], vocab.CATEGORY_REVIEW, "Inventada", "", None]
    assert one_col(scoring.valid_category, values) == [True, True, False, None, None]
