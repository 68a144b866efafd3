"""Literal edge cases of the scalar functions (hand-derived expectations)."""

from pyspark.sql import functions as F

from plenaria.functions import authors, labels, text
from plenaria.functions.json_fields import quantise_score, response_fields, status_fields
from plenaria.operators.term_match import first_term
from plenaria import vocab


def test_proposal_number(one_col):
    assert one_col(text.proposal_number, ["PL 123/2004", "77", "PL 5/04", None]) == ["123", "77", "PL 5/04", None]


def test_author_kind(spark):
    rows = [("PT", "Deputado"), ("", "Deputada"), ("", "Órgão"), ("", "Executivo"), ("", "Outra")]
    df = spark.createDataFrame(rows, "p string, t string")
    got = [r[0] for r in df.select(authors.author_kind("p", "t")).collect()]
    assert got == ["PT", "Sem partido", "Comissão", "Executivo", "Outra"]


def test_senate_author(spark):
    cases = [
        ("Senador Zé da Silva (UNIÃO/SP)", "x", ("Zé da Silva", "UNIÃO", "SP")),
        ("Senadora Ana (PT/BA)", "x", ("Ana", "PT", "BA")),
        ("Presidência da República", "x", ("Presidência da República", "Executivo", "")),
        ("Comissão de Assuntos Sociais", "x", ("Comissão de Assuntos Sociais", "Comissão", "")),
        ("STF", "x", ("STF", "Judiciário", "")),
        ("stf", "x", ("stf", "Comissão", "")),
        ("Ministério Público da União", "x", ("Ministério Público da União", "MPU", "")),
        ("Câmara dos Deputados", "x", ("Câmara dos Deputados", "Legislativo", "")),
        ("Senador Fulano", "x", ("Senador Fulano", "Legislativo", "")),
        ("Senadora Ana (PT/BA)", "Sugestão", ("Senadora Ana (PT/BA)", "Popular; Comissão", "")),
        ("", "x", ("", "Comissão", "")),
        (None, "x", ("", "Comissão", "")),
    ]
    df = spark.createDataFrame([(a, t) for a, t, _ in cases], "a string, t string")
    got = [tuple(r) for r in df.select(authors.senate_author("a", "t").alias("s")).select("s.*").collect()]
    assert got == [e for _, _, e in cases]


def test_status_label(one_col):
    cases = {"Transformado em Norma Jurídica": "Promulgada", "Aprovado o Substitutivo": "Promulgada",
             "Não conhecida": "Promulgada", "VETO DELIBERADO": "Promulgada", "Vetada totalmente": "Arquivada",
             "Devolvida ao Relator": "Arquivada", "Tramitação em conjunto": "Em tramitação",
             "Transformado em nova proposição": "Em tramitação", "XPTO": "Outro", "": "Sem informação",
             " \t": "Sem informação", None: "Sem informação"}
    assert one_col(labels.status_label, list(cases)) == list(cases.values())


def test_normalise_party(one_col):
    stage1 = {" PT* ": "PT", "S. PART.": "0 - Sem Partido", "Sem partido": None, "PODE": "PODEMOS",
                "MDB": "PMDB/MDB", "CPI MISTA": None, "REPUBLICANOS": "REPUBLICANOS", "SOLIDARIEDADE": None,
                "Popular": "0 - Popular", "S/PART": "S/PART"}
    assert one_col(authors.normalise_party, list(stage1)) == list(stage1.values())
    assert one_col(lambda c: authors.normalise_party(c, dashboard=True), ["S/PART", "Iniciativa Popular"]) == \
        ["0 - Sem Partido", None]


def test_party_of_author(one_col):
    cases = {"PP; PT": "PP", "Executivo; PSOL": "PSOL", "CPI MISTA; PT": None, "Popular; Comissão": "0 - Popular",
             "SOLIDARIEDADE; PT": "PT", "—": None, "": None, None: None}
    assert one_col(authors.party_of_author, list(cases)) == list(cases.values())


def test_ideology_band(one_col):
    vals = [3.0, 3.01, 4.5, 5.5, 7.0, 7.01, None]
    assert one_col(labels.ideology_band, vals, "double") == [
        "Esquerda", "Centro-Esquerda", "Centro-Esquerda", "Centro", "Centro-Direita", "Direita", "Não identificado"]


def test_legislature(one_col):
    got = one_col(labels.legislature, [1900, 1990, 1991, 2022, 2023, 2100, None], "int")
    assert [g[:3] if g else g for g in got] == ["48ª", "48ª", "49ª", "56ª", "57ª", "57ª", None]


def test_is_member_and_group(one_col):
    assert one_col(authors.is_member, ["Executivo", "Popular; Comissão", "Executivo; PSOL", "SOLIDARIEDADE", None]) == \
        [False, True, True, False, False]
    cases = {"PP; PT": "Políticos", "Executivo; PSOL": "Executivo", "Popular; Comissão": "Políticos",
             "SOLIDARIEDADE; Comissão": "Comissão", "; PT": "Não identificado", "—": "Não identificado",
             None: "Não identificado"}
    assert one_col(authors.author_group, list(cases)) == list(cases.values())


def test_titles_and_names(one_col):
    assert one_col(text.title_term, ["transferência de renda", "de olho na renda"]) == \
        ["Transferência de Renda", "De Olho na Renda"]
    assert one_col(text.person_name, ["MARIA DAS DORES (PT/SP)", "de souza-cruz e lima", "  ", None]) == \
        ["Maria das Dores", "de Souza-cruz e Lima", "", None]


def test_quantise(one_col):
    assert one_col(quantise_score, [0.625, 7.3, 5.875, 6.125, 12.0, -1.0, None, float("nan")], "double") == \
        [0.5, 7.25, 6.0, 6.0, 10.0, 0.0, None, None]


def test_date_text(one_col):
    assert one_col(text.date_text, ["1999-01-02T10:00", "1999-01-02", "bad", "", None]) == \
        ["1999-01-02", "1999-01-02", None, None, None]


def test_response_fields(spark):
    cases = [('{"nota":"7.3"}', (7.25, "", "incluir", "")), ('{"categoria":"x"}', (0.0, "x", "excluir", "")),
             ('{"nota":null}', (None, "", "", "")), ('{"nota":"alta"}', (None, "", "", "")),
             ("not json", (None, "", "", "")), ("[1]", (None, "", "", "")), ('{"nota": 7', (None, "", "", "")),
             ("{}", (0.0, "", "excluir", "")),
             ('{"nota": 9, "categoria": "Pobreza", "justificativa": "ok"}', (9.0, "Pobreza", "incluir", "ok"))]
    df = spark.createDataFrame([(c,) for c, _ in cases], "raw string")
    got = [tuple(r) for r in df.select(response_fields("raw", 6.0).alias("r")).select("r.*").collect()]
    assert got == [e for _, e in cases]


def test_status_json(spark):
    raws = ['{"m":{"a":{"s":{"d":"Arquivada","t":"2001-01-01"}}}}',
            '{"m":[{"a":[{"s":[{"d":"Aguardando Parecer","t":"2001-01-01"},{"t":"2002-02-02"}]},{"s":{"d":"Norma"}}]}]}',
            '{"m":[]}', '{"broken":']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [tuple(r) for r in df.select(status_fields(F.col("raw")).alias("s")).select("s.*").collect()]
    assert got == [("Arquivada", "2001-01-01"), ("Norma", "2002-02-02"), ("", ""), ("", "")]


def test_first_term(one_col):
    got = one_col(lambda c: first_term(c, vocab.SEARCH_TERMS),
                  ["Erradicação da Pobreza e extrema pobreza", "EXTREMA POBREZA", "nada", None])
    assert got == ["erradicação da pobreza", "extrema pobreza", None, None]


def test_display_numbers(one_col):
    assert one_col(text.thousands_br, [1234567], "bigint") == ["1.234.567"]
    assert one_col(text.decimal_br, [394.75, 0.25], "double") == ["394,8", "0,2"]
    assert one_col(text.percent_text, [0.1234], "double") == ["12.3%"]


def test_round_exact_matches_python(one_col):
    import random
    rnd = random.Random(11)
    vals = [5.335, 2.675, 0.125, 0.375, 1.005, 3.0, -2.675, 7.125] + \
        [rnd.randint(0, 100000) / 1000 for _ in range(300)] + [(rnd.randint(100, 1000) + rnd.randint(100, 1000)) / 200
                                                               for _ in range(300)]
    got = one_col(lambda c: text.round_exact(c, 2), vals, "double")
    assert got == [round(v, 2) for v in vals]


def test_response_parsing_is_strict(spark):
    raws = ["{'nota': 7}", '{"nota": 7} lixo', '{"nota":8}{"nota":2}', '{"nota":"7.3d"}', '{"nota":"8f"}', '{"nota": true}',
            '{"nota":"7.5"}', '[{"nota":7}]', '{"nota":8}', None, '{"nota":8},{"nota":2}']
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [r[0] for r in df.select(response_fields("raw")["llm_nota"]).collect()]
    assert [x is not None for x in got] == [False, False, False, False, False, True, True, False, True, False, False]


def test_status_on_nested_paths(spark):
    raw = ('{"SituacaoAtualMateria":{"Materias":{"Materia":[{"SituacaoAtual":{"Autuacoes":{"Autuacao":{"Situacoes":{"Situacao":'
           '[{"DescricaoSituacao":"A","DataSituacao":"2020-01-01"},{"DescricaoSituacao":"B"}]}}}}}]}}}')
    got = spark.createDataFrame([(raw,), ("{}",), ("erro",), (None,)], "raw string").select(status_fields(
        F.col("raw"), "SituacaoAtualMateria.Materias.Materia", "SituacaoAtual.Autuacoes.Autuacao", "Situacoes.Situacao",
        "DescricaoSituacao", "DataSituacao").alias("s")).select("s.*").collect()
    assert [tuple(r) for r in got] == [("B", "2020-01-01"), ("", ""), ("", ""), ("", "")]
