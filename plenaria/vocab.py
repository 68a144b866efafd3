"""Fixed values of the policy-document domain.

FIXED VALUES: every list and map below must equal the domain's published
configuration and code tables for results to agree (search terms, type codes,
labels, survey column map, proxy parties, institutional author names, status
keywords, scoring rubric).  They are stated here once, in their natural order,
and every operator takes them as default arguments so callers can pass their own.
"""

from __future__ import annotations

# ---------------------------------------------------------------- FIXED VALUES
# Collection window and search vocabulary.
YEAR_START = 1988
YEAR_END = 2025

SEARCH_TERMS = [
    "erradicação da pobreza",
    "extrema pobreza",
    "pobreza",
    "vulnerabilidade social",
    "transferência de renda",
    "desigualdade social",
    "proteção social",
    "assistência social",
    "inclusão social",
    "bolsa família",
    "benefício de prestação continuada",
    "renda mínima",
]

CHAMBER_TYPES = [
    "PL", "PLP", "PEC", "MPV", "PDL", "PDC", "PLV", "PLS",
    "PLC", "PLN", "PRC", "PRN", "MSC", "MSG", "PFC", "SUG",
]

SENATE_TYPES = [
    "Medida Provisória",
    "Projeto de Lei Ordinária",
    "Projeto de Lei da Câmara",
    "Projeto de Lei Complementar",
    "Projeto de Lei do Senado",
    "Projeto de Lei de Conversão",
    "Projeto de Decreto Legislativo",
    "Projeto de Resolução",
    "Proposta de Emenda à Constituição",
    "Proposta de Fiscalização e Controle",
    "Sugestão",
    "Mensagem",
]

SENATE_CONTENT_TYPES = [
    "Norma Geral",
    "Norma Jurídica",
    "Norma Jurídica - não categorizada",
    "Fiscalização e controle de atos do Poder Executivo",
    "Sustação de ato do Poder Executivo",
    "Proposta de Fiscalização e Controle",
    "Veto Constitucional",
    "Apreciação de Atos/tratados/acordos internacionais",
]

EXCLUDED_SUBJECTS = ["Data comemorativa", "Crédito Suplementar", "Comunicações"]

# Summary exclusion pattern, case-insensitive.  The configured text is a folded
# scalar, so the line break became a space after the first alternative.
SUMMARY_EXCLUSION_PATTERN = (
    "abre crédito (?:extraordinário|suplementar) "
    "|\\b(?:comenda|medalha|título honorário|homenagem)\\b"
)

# Proposal type normalisation (raw type -> code); unknown types stay as they are.
TYPE_NORMALISATION = {
    "PL": "PL", "PLP": "PLP", "PEC": "PEC", "MPV": "MPV",
    "PDL": "PDL", "PDC": "PDL",
    "PLV": "PLV", "PLS": "PLS", "PLC": "PLC", "PLN": "PLN",
    "PRC": "PRC", "PRN": "PRN",
    "MSC": "MSG", "MSG": "MSG",
    "PFC": "PFC", "SUG": "SUG",
    "Medida Provisória": "MPV",
    "Projeto de Lei Ordinária": "PL",
    "Projeto de Lei da Câmara": "PLC",
    "Projeto de Lei Complementar": "PLP",
    "Projeto de Lei do Senado": "PLS",
    "Projeto de Lei de Conversão": "PLV",
    "Projeto de Decreto Legislativo": "PDL",
    "Projeto de Resolução": "PRC",
    "Proposta de Emenda à Constituição": "PEC",
    "Proposta de Emenda Constitucional": "PEC",
    "Mensagem": "MSG",
    "Proposta de Fiscalização e Controle": "PFC",
    "Sugestão": "SUG",
}

# Raw author type -> author category; None means "a member of parliament".
AUTHOR_TYPE_MAP = {
    "Deputado": None,
    "Deputada": None,
    "Deputado(a)": None,
    "Senador": None,
    "Senadora": None,
    "Senador(a)": None,
    "Órgão": "Comissão",
    "Executivo": "Executivo",
    "Senado Federal": "Legislativo",
    "Poder Judiciário": "Judiciário",
    "Tribunal de Contas": "TCU",
    "Ministério Público": "MPU",
    "Sociedade Civil": "Iniciativa Popular",
}
# Raw author types for which a member profile lookup is allowed.
MEMBER_TYPES = ["Deputado(a)", "Deputado", "Senador(a)", "Senador"]
NO_PARTY_LABEL = "Sem partido"
POPULAR_AUTHOR = "Popular; Comissão"

# Senate author text: ordered keyword tests (lower-cased text unless noted).
SENATE_AUTHOR_PATTERN = r"^Senador[a]?\s+(.+?)\s+\((\w+)/(\w+)\)$"
EXECUTIVE_KEYWORDS = ["presidência", "executivo", "governo federal"]
COMMITTEE_KEYWORDS = ["comissão", "comissao"]
COURT_ACRONYMS = ["STF", "STJ", "TSE", "TST"]  # case-sensitive test
PROSECUTION_KEYWORDS = ["ministério público"]
LEGISLATURE_KEYWORDS = ["câmara", "senado"]

# Status harmonisation: first label whose keyword list hits the upper-cased text.
STATUS_RULES = [
    ("Promulgada", ["NORMA", "PROMULGAD", "SANCIONAD", "CONHECIDA",
                    "APROVADO", "VETO DELIBERADO"]),
    ("Arquivada", ["ARQUIVAD", "PREJUDICAD", "RETIRAD",
                   "SEM EFICÁCIA", "PERDEU A EFICÁCIA",
                   "REJEITADA", "TRAMITAÇÃO ENCERRADA",
                   "TRAMITAÇÃO FINALIZADA", "VETADA",
                   "REVOGADA", "AUTUAÇÃO FINALIZADA",
                   "DESMEMBRADA", "DEVOLVIDA"]),
    ("Em tramitação", ["AGUARDANDO", "PAUTA", "CONJUNTO", "RELATOR",
                       "REMETIDA", "TRANSFORMADA EM PROJETO",
                       "TRANSFORMADO EM NOVA", "EM TRAMITAÇÃO",
                       "PRONTO PARA", "PEDIDO DE VISTA",
                       "APROVADO O SUBSTITUTIVO",
                       "EM TRAMITAÇÃO ANTES"]),
]
STATUS_OTHER = "Outro"
STATUS_MISSING = "Sem informação"

# Survey column -> party (left-right placement columns).
SURVEY_PARTY_COLUMNS = {
    "lrpt": "PT", "lrpsdb": "PSDB", "lrpmdb": "PMDB/MDB",
    "lrmdb": "PMDB/MDB", "lrpfl": "PFL", "lrdem": "DEM",
    "lrpl": "PL", "lrpp_ppb": "PP", "lrpp": "PP",
    "lrpdt": "PDT", "lrpsb": "PSB", "lrpcdob": "PCdoB",
    "lrptb": "PTB", "lrpsol": "PSOL", "lrpsd": "PSD",
    "lrprn": "PRN", "lrpps": "PPS", "lrpr": "PR",
    "lrpros": "PROS", "lrrede": "REDE", "lrpode": "PODEMOS",
    "lrnovo": "NOVO", "lrrep": "REPUBLICANOS", "lrpsc": "PSC",
    "lrpv": "PV", "lrprb": "PRB", "lrpstu": "PSTU",
    "lrpcb": "PCB", "lrpsl": "PSL", "lrpdc": "PDC",
    "lrpds": "PDS", "lrppr": "PPR", "lrptn": "PTN",
    "lrsd": "SD", "lrcid": "CIDADANIA",
}
SURVEY_MISSING = -999

# Stand-in parties for parties the survey does not cover; None = never scored.
PARTY_PROXIES = {
    "ARENA": ["PDS"],
    "PPB": ["PP"],
    "AVANTE": ["PDT"],
    "UNIÃO": ["DEM", "PSL"],
    "PR": ["PL"],
    "MISSÃO": ["NOVO", "PSL"],
    "DEM": ["DEM", "PFL"],
    "PFL": ["PFL", "DEM"],
    "PHS": ["PROS", "PSD"],
    "PRD": ["PL", "PP"],
    "PST": ["PTB"],
    "PMN": ["PMDB/MDB"],
    "PSDC": ["PSC", "PP"],
    "SDD": None,
    "SOLIDARIEDADE": None,
    "SOLID": None,
    "PTC": None,
    "AGIR": None,
}

# Author texts that are institutions, not parties.
INSTITUTIONAL = [
    "Executivo", "Comissão", "Legislativo", "Judiciário", "TCU", "MPU",
    "Iniciativa Popular", "Popular; Comissão", "Sem partido", "—", "",
]
MAX_PARTY_LEN = 12
NO_PARTY_ALIASES = ["S. PART.", "S.PART.", "SEM PARTIDO", "Sem partido"]
NO_PARTY_ALIASES_DASHBOARD = NO_PARTY_ALIASES + ["S/PART"]
POPULAR_ALIASES = ["Popular", "POPULAR"]
POPULAR_ALIASES_DASHBOARD = POPULAR_ALIASES + ["Iniciativa Popular"]
NO_PARTY_CODE = "0 - Sem Partido"
POPULAR_CODE = "0 - Popular"
PARTY_RENAMES = {"PODE": "PODEMOS", "PODEMOS": "PODEMOS", "MDB": "PMDB/MDB", "PMDB": "PMDB/MDB"}
PARTY_DROP_MARKERS = ["MISTA", "CPI"]

# Ideology bands: right-closed upper bounds.
IDEOLOGY_BANDS = [
    (3.0, "Esquerda"),
    (4.5, "Centro-Esquerda"),
    (5.5, "Centro"),
    (7.0, "Centro-Direita"),
]
IDEOLOGY_TOP_BAND = "Direita"
IDEOLOGY_UNKNOWN = "Não identificado"
IDEOLOGY_BAND_ORDER = ["Esquerda", "Centro-Esquerda", "Centro", "Centro-Direita",
                       "Direita", "Não identificado"]

# Dashboard labels.
HOUSE_LABEL = {
    "CD": "Câmara dos Deputados",
    "SF": "Senado Federal",
    "CN": "Congresso Nacional",
}
HOUSE_CHAMBER = {"CD": "Câmara", "SF": "Senado", "CN": "Senado"}

TYPE_LABEL = {
    "PL": "Projeto de Lei",
    "PLP": "Projeto de Lei Complementar",
    "PEC": "Proposta de Emenda Constitucional",
    "MPV": "Medida Provisória",
    "PDL": "Projeto de Decreto Legislativo",
    "PLV": "Projeto de Lei de Conversão",
    "PLS": "Projeto de Lei do Senado",
    "PLC": "Projeto de Lei da Câmara (SF)",
    "PLN": "Projeto de Lei do Congresso",
    "PRC": "Projeto de Resolução",
    "PRN": "Projeto de Resolução do CN",
    "MSG": "Mensagem",
    "PFC": "Proposta de Fiscalização e Controle",
    "SUG": "Sugestão (Iniciativa Popular)",
}

STATE_REGION = {
    "AC": "Norte", "AM": "Norte", "AP": "Norte", "PA": "Norte",
    "RO": "Norte", "RR": "Norte", "TO": "Norte",
    "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste",
    "PB": "Nordeste", "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste",
    "SE": "Nordeste",
    "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MS": "Centro-Oeste", "MT": "Centro-Oeste",
    "ES": "Sudeste", "MG": "Sudeste", "RJ": "Sudeste", "SP": "Sudeste",
    "PR": "Sul", "RS": "Sul", "SC": "Sul",
}
REGION_UNKNOWN = "Não identificada"
REGION_ORDER = ["Norte", "Nordeste", "Centro-Oeste", "Sudeste", "Sul", "Não identificada"]

# Legislatures: (last calendar year included, label); the last band is open.
LEGISLATURES = [
    (1990, "48ª (1987-1991)"),
    (1994, "49ª (1991-1995)"),
    (1998, "50ª (1995-1999)"),
    (2002, "51ª (1999-2003)"),
    (2006, "52ª (2003-2007)"),
    (2010, "53ª (2007-2011)"),
    (2014, "54ª (2011-2015)"),
    (2018, "55ª (2015-2019)"),
    (2022, "56ª (2019-2023)"),
    (None, "57ª (2023-2027)"),
]

TYPE_GROUP = {
    "PL": "Projetos de Lei", "PLP": "Projetos de Lei",
    "PLS": "Projetos de Lei", "PLC": "Projetos de Lei",
    "PLN": "Projetos de Lei",
    "PEC": "Emendas Constitucionais",
    "MPV": "Medidas Provisórias", "PLV": "Medidas Provisórias",
    "PDL": "Decretos Legislativos",
    "PRC": "Outros", "PRN": "Outros", "MSG": "Outros",
    "PFC": "Outros", "SUG": "Outros",
}
TYPE_GROUP_ORDER = ["Projetos de Lei", "Emendas Constitucionais", "Medidas Provisórias",
                    "Decretos Legislativos", "Outros"]
OTHERS = "Outros"
TOTAL = "Total"

# Portuguese particles kept lower-case in titles and names.
LOWER_PARTICLES = ["de", "da", "do", "das", "dos", "e", "em", "com", "por", "para",
                   "a", "o", "as", "os", "no", "na", "nos", "nas"]

PLACEHOLDER = "—"

# Relevance scoring rubric.
SCORE_CUTOFF = 6.0
SCORE_MIN = 0.0
SCORE_MAX = 10.0
SCORE_STEP = 0.25
MAX_ATTEMPTS = 3
DECISION_INCLUDE = "incluir"
DECISION_EXCLUDE = "excluir"

CATEGORIES = [
    "Assistência Social",
    "Benefício de Prestação Continuada",
    "Pobreza",
    "Desigualdade Social",
    "Renda Mínima",
    "Proteção Social",
    "Erradicação da Pobreza",
    "Inclusão Social",
    "Bolsa Família",
    "Extrema Pobreza",
    "Transferência de Renda",
    "Vulnerabilidade Social",
]
CATEGORY_REVIEW = "Indefinido - Revisão Humana"

SCORE_SCALE = {
    "9.0-10.0": "Proposição trata do tema como objeto central e exclusivo",
    "7.5-8.75": "Tema é objeto principal; outros elementos são secundários",
    "6.0-7.25": "Tema é relevante e substantivo, ainda que não exclusivo",
    "4.0-5.75": "Tema aparece como elemento importante mas não central",
    "2.0-3.75": "Tema mencionado de forma tangencial ou instrumental",
    "0.0-1.75": "Tema ausente ou meramente retórico",
}

ACRONYMS = {
    "BPC": "Benefício de Prestação Continuada",
    "LOAS": "Lei Orgânica da Assistência Social",
    "PBF": "Programa Bolsa Família",
    "RMV": "Renda Mensal Vitalícia",
    "PETI": "Programa de Erradicação do Trabalho Infantil",
    "PAA": "Programa de Aquisição de Alimentos",
    "PNAE": "Programa Nacional de Alimentação Escolar",
    "SUAS": "Sistema Único de Assistência Social",
    "FNAS": "Fundo Nacional de Assistência Social",
    "CRAS": "Centro de Referência de Assistência Social",
    "CREAS": "Centro de Referência Especializado de Assistência Social",
    "CadÚnico": "Cadastro Único para Programas Sociais",
    "BSM": "Brasil Sem Miséria",
    "ProJovem": "Programa Nacional de Inclusão de Jovens",
    "AE": "Auxílio Emergencial",
}

INCLUSION_CRITERIA = [
    "A proposição cria, altera ou regula políticas, programas ou benefícios voltados a "
    "populações em situação de pobreza ou vulnerabilidade social",
    "Alterações diretas de acesso, valor ou critérios de elegibilidade de benefícios de "
    "proteção social são sempre objeto central, independentemente de serem expansivas ou "
    "restritivas",
    "A proposição tem impacto direto sobre renda, acesso a serviços ou direitos sociais de "
    "populações vulneráveis",
    "A proposição trata de transferência de renda, assistência social ou proteção social "
    "como objeto substantivo",
]

EXCLUSION_CRITERIA = [
    "Pobreza ou desigualdade aparecem apenas como justificativa retórica, sem ser o objeto "
    "da proposição",
    "A proposição trata de outro tema onde o tema aparece tangencialmente",
    "A proposição é exclusivamente orçamentária, comemorativa ou de organização "
    "administrativa interna",
    "O termo foi capturado por indexação indireta sem relação substantiva com o objeto da "
    "proposição",
]
# -------------------------------------------------------------- END FIXED VALUES
