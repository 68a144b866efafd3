"""Relevance-rubric prompt text (L1).

FIXED VALUES: the rubric wording, in order, with the five slots the prompt
builder fills (context block, category list, inclusion and exclusion criteria,
acronym list).  ``PROMPT_PARTS[i]`` precedes ``PROMPT_SLOTS[i]``; the last part
closes the prompt.
"""

# ---------------------------------------------------------------- FIXED VALUES
PROMPT_SLOTS = ['ctx', 'cats', 'inc', 'exc', 'siglas_fmt']

PROMPT_PARTS = [
    '\nVocê é um especialista em políticas públicas de combate à pobreza e desigualdade social no Brasil.\nAvalie a relevância da proposição legislativa abaixo para o tema de pobreza e desigualdade social, atribuindo uma nota de 0 a 10 (múltiplos de 0.25).\n\nPROPOSIÇÃO:\n',
    '\n\n═══════════════════════════════════════════════════════════\nESCALA DE RELEVÂNCIA\n═══════════════════════════════════════════════════════════\nAbaixo, você recebeu exemplos concretos para cada grupo de notas. Use os exemplos abaixo para aperfeiçoar seu processo decisório. Lembre-se que estes são apenas EXEMPLOS.\n\n9.0–10.0: Objeto central e exclusivo. O tema é a razão de ser da proposição. Não existe outra interpretação possível. Exemplos:\n    • "Institui o Programa Bolsa Família e define critérios de elegibilidade e valores de transferência de renda para famílias em situação de pobreza"\n    • "Altera os critérios de acesso ao BPC para ampliar cobertura a idosos e pessoas com deficiência em extrema pobreza"\n\n7.5–8.75: Objeto principal, com elementos secundários. A proposição trata centralmente do tema, mas abrange aspectos adicionais. Exemplos:\n    • "Dispõe sobre o Estatuto do Idoso, estabelecendo direitos, proteções sociais e benefícios assistenciais para pessoas com 60 anos ou mais"\n    • "Altera a LOAS para incluir portadores de esclerose lateral amiotrófica no BPC, independentemente do critério de renda familiar"\n\n6.0–7.25: Relevante e substantivo, mas não exclusivo. O tema é um componente importante da proposição, ainda que coexista com outros objetos. Exemplos:\n    • "Altera a Lei de Responsabilidade Fiscal para excluir do limite de despesas de pessoal os recursos destinados ao Programa Saúde da Família e aos Centros de Referência de Assistência Social (CRAS)"\n    • "Institui o Plano Nacional de Juventude, com eixos de educação, trabalho e inclusão social para jovens em situação de vulnerabilidade"\n\n4.5–5.75: Elemento importante, mas não central. O tema de pobreza ou desigualdade é abordado, mas divide espaço com outros objetos de igual ou maior peso. Exemplos:\n    • "Institui o Estatuto da Micro e Pequena Empresa, com benefícios tributários que favorecem empreendedores de baixa renda e trabalhadores informais"\n    • "Altera o Código de Defesa do Consumidor para definir critérios de essencialidade de produtos para pessoas com deficiência"\n\n2.0–4.0: Menção tangencial ou instrumental. O tema aparece como justificativa, objetivo genérico ou efeito colateral esperado de uma política setorial com outro foco central. Exemplos:\n    • "Destina percentual dos royalties de petróleo a municípios para erradicação da miséria e redução de desigualdades regionais" — pobreza é objetivo declarado genérico demais\n    • "Dispõe sobre a Política Nacional de Energia Nuclear, tendo entre seus objetivos a soberania, o desenvolvimento nacional e a erradicação do estado de pobreza" — pobreza como argumento retórico\n\n0.0–1.75: Ausente ou meramente retórico. O tema não é objeto da proposição. Aparece apenas na indexação interna, em preâmbulos genéricos ou não aparece. Exemplos:\n    • "Concede a Medalha do Mérito Legislativo ao servidor público destacado"\n    • "Dispõe sobre a Política Nacional de Ciência e Tecnologia e o fomento à pesquisa de ponta" — pobreza foi capturada por indexação indireta\n\n═══════════════════════════════════════════════════════════\nATENÇÃO — TEMA ACESSÓRIO OU RETÓRICO\n═══════════════════════════════════════════════════════════\nAtribua nota ABAIXO DE 5.0 quando identificar qualquer um dos seguintes padrões:\n- Pobreza ou desigualdade aparecem apenas na justificativa ou nos "considerandos" da proposição, sem se refletir no dispositivo normativo\n- A proposição trata de política setorial (energia, infraestrutura, agronegócio, segurança pública) e menciona redução da pobreza como objetivo genérico de desenvolvimento nacional\n- O mecanismo proposto é fiscal ou distributivo (royalties, fundos, incentivos tributários) e a destinação a populações pobres é uma entre várias finalidades possíveis\n- A proposição foi capturada pelo sistema de busca por conter os termos na indexação interna, mas a ementa e o conteúdo tratam de outro assunto\n\n═══════════════════════════════════════════════════════════\nCATEGORIAS TEMÁTICAS\n═══════════════════════════════════════════════════════════\n',
    '\n\nREGRA OBRIGATÓRIA: NUNCA invente categorias fora desta lista. Escolha EXATAMENTE uma das categorias acima. \nSe a proposição não se encaixar com clareza em nenhuma delas, preencha obrigatoriamente com: "Indefinido - Revisão Humana".\n\n═══════════════════════════════════════════════════════════\nCRITÉRIOS\n═══════════════════════════════════════════════════════════\nCritérios de Inclusão: ',
    '\nCritérios de Exclusão: ',
    '\n\n═══════════════════════════════════════════════════════════\nPROGRAMAS E BENEFÍCIOS DE REFERÊNCIA\n═══════════════════════════════════════════════════════════\nAs siglas e programas abaixo são instrumentos centrais de proteção social no Brasil. \nProposições que os mencionem diretamente no dispositivo normativo recebem nota SUPERIOR A 7.0, salvo motivo extremamente forte (sigla usada claramente como retórica ou pretexto).\n',
    '\n\n═══════════════════════════════════════════════════════════\n\nRetorne APENAS um JSON válido, sem texto adicional:\n{\n    "nota": <número entre 0 e 10, múltiplo de 0.25>,\n    "categoria": "<categoria da lista ou \'Indefinido - Revisão Humana\'>",\n    "justificativa": "<uma frase explicando a nota>"\n}\n',
]
# -------------------------------------------------------------- END FIXED VALUES
