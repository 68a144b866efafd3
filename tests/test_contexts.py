"""Contexts by uri from both houses' payloads."""

import json

from plenaria.plans import contexts

CD = json.dumps({"dados": {"keywords": "renda", "ementaDetalhada": None}})
SF = json.dumps({"DetalheMateria": {"Materia": {"IndexacaoMateria": "", "EmentaMateria": "longa"}}})


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def table(spark, responses):
    return contexts.context_table(spark.createDataFrame(responses, "uri string, origem string, raw string"))


def test_each_house_has_its_shape(spark):
    got = rows(table(spark, [("a", "CD", CD), ("b", "SF", SF), ("c", "CN", "erro"), ("d", "CD", None), ("e", None, SF),
                             ("a", "CD", CD), ("f", "CD", SF), (None, "CD", CD)]))
    assert got == rows(spark.createDataFrame([
        ("a", True, "renda", "", None), ("b", False, None, None, "longa"), ("c", False, None, None, ""), ("d", True, "", "", None),
        ("e", False, None, None, "longa"), ("f", True, "", "", None)], "u string, c boolean, k string, e string, i string"))


def test_proposals_get_the_context_of_their_house(spark):
    stage = spark.createDataFrame([(1, "a", "CD"), (2, "a", "SF"), (3, "b", "SF"), (4, None, "CD"), (5, "z", "CD"), (6, "b", None)],
                                  "i int, uri string, origem string")
    found = contexts.with_context(stage, table(spark, [("a", "CD", CD), ("b", "SF", SF)]))
    assert rows(found.select("i", "keywords", "ementa_detalhada", "indexacao")) == [
        (1, "renda", "", None), (2, None, None, None), (3, None, None, "longa"), (4, None, None, None), (5, None, None, None),
        (6, None, None, "longa")]


def test_the_text_has_lines_for_what_is_there(spark):
    stage = spark.createDataFrame([(1, "a", "CD", "PL", "7", "2001", "Sobre"), (2, None, "SF", "PEC", "8", "2002", None)],
                                  "i int, uri string, origem string, tipo string, numero string, ano string, ementa string")
    got = dict(rows(contexts.context_texts(stage, table(spark, [("a", "CD", CD)]), "i")))
    assert got[1].split("\n") == ["Casa:      CD", "Proposta:  PL 7/2001", "Ementa:    Sobre", "Indexação: renda"]
    assert got[2].split("\n") == ["Casa:      SF", "Proposta:  PEC 8/2002", "Ementa:    "]
