"""The vocabulary the warehouse must reproduce exactly.

All lists below are fixed values (code tables, labels, defaults, column names);
they carry no logic.  The helpers that use them live in the other modules.
"""

from __future__ import annotations

NOT_INFORMED = "NÃO INFORMADO"
UNKNOWN_CODE = "XX"

# Brazilian states as (IBGE code, abbreviation, name, region).
STATES = [
    (11, "RO", "Rondônia", "NORTE"),
    (12, "AC", "Acre", "NORTE"),
    (13, "AM", "Amazonas", "NORTE"),
    (14, "RR", "Roraima", "NORTE"),
    (15, "PA", "Pará", "NORTE"),
    (16, "AP", "Amapá", "NORTE"),
    (17, "TO", "Tocantins", "NORTE"),
    (21, "MA", "Maranhão", "NORDESTE"),
    (22, "PI", "Piauí", "NORDESTE"),
    (23, "CE", "Ceará", "NORDESTE"),
    (24, "RN", "Rio Grande do Norte", "NORDESTE"),
    (25, "PB", "Paraíba", "NORDESTE"),
    (26, "PE", "Pernambuco", "NORDESTE"),
    (27, "AL", "Alagoas", "NORDESTE"),
    (28, "SE", "Sergipe", "NORDESTE"),
    (29, "BA", "Bahia", "NORDESTE"),
    (31, "MG", "Minas Gerais", "SUDESTE"),
    (32, "ES", "Espírito Santo", "SUDESTE"),
    (33, "RJ", "Rio de Janeiro", "SUDESTE"),
    (35, "SP", "São Paulo", "SUDESTE"),
    (41, "PR", "Paraná", "SUL"),
    (42, "SC", "Santa Catarina", "SUL"),
    (43, "RS", "Rio Grande do Sul", "SUL"),
    (50, "MS", "Mato Grosso do Sul", "CENTRO-OESTE"),
    (51, "MT", "Mato Grosso", "CENTRO-OESTE"),
    (52, "GO", "Goiás", "CENTRO-OESTE"),
    (53, "DF", "Distrito Federal", "CENTRO-OESTE"),
]

# Weekday names, Monday first.
WEEKDAYS = [
    "SEGUNDA-FEIRA",
    "TERÇA-FEIRA",
    "QUARTA-FEIRA",
    "QUINTA-FEIRA",
    "SEXTA-FEIRA",
    "SÁBADO",
    "DOMINGO",
]

# The 20 development goals as (number, name, description, theme category).
GOALS = [
    (1, "Erradicação da pobreza", "Acabar com a pobreza em todas as suas formas, em todos os lugares.", "Social"),
    (2, "Fome zero e agricultura sustentável", "Acabar com a fome, alcançar a segurança alimentar e melhorar a nutrição e promover a agricultura sustentável.", "Social-Ambiental"),
    (3, "Saúde e bem-estar", "Assegurar uma vida saudável e promover o bem-estar para todos, em todas as idades.", "Social"),
    (4, "Educação de qualidade", "Assegurar a educação inclusiva e equitativa e de qualidade, e promover oportunidades de aprendizagem ao longo da vida para todos.", "Social"),
    (5, "Igualdade de gênero", "Alcançar a igualdade de gênero e empoderar todas as mulheres e meninas.", "Social"),
    (6, "Água potável e saneamento", "Assegurar a disponibilidade e gestão sustentável da água e saneamento para todos.", "Ambiental"),
    (7, "Energia limpa e acessível", "Assegurar o acesso confiável, sustentável, moderno e a preço acessível à energia para todos.", "Ambiental-Econômico"),
    (8, "Trabalho decente e crescimento econômico", "Promover o crescimento econômico sustentado, inclusivo e sustentável, emprego pleno e produtivo e trabalho decente para todos.", "Econômico-Social"),
    (9, "Indústria, inovação e infraestrutura", "Construir infraestruturas resilientes, promover a industrialização inclusiva e sustentável e fomentar a inovação.", "Econômico"),
    (10, "Redução das desigualdades", "Reduzir a desigualdade dentro dos países e entre eles.", "Social"),
    (11, "Cidades e comunidades sustentáveis", "Tornar as cidades e os assentamentos humanos inclusivos, seguros, resilientes e sustentáveis.", "Social-Ambiental"),
    (12, "Consumo e produção responsáveis", "Assegurar padrões de produção e de consumo sustentáveis.", "Ambiental-Econômico"),
    (13, "Ação contra a mudança global do clima", "Tomar medidas urgentes para combater a mudança climática e seus impactos.", "Ambiental"),
    (14, "Vida na água", "Conservar e usar sustentavelmente os oceanos, os mares e os recursos marinhos para o desenvolvimento sustentável.", "Ambiental"),
    (15, "Vida terrestre", "Proteger, recuperar e promover o uso sustentável dos ecossistemas terrestres, gerir de forma sustentável as florestas, combater a desertificação.", "Ambiental"),
    (16, "Paz, justiça e instituições eficazes", "Promover sociedades pacíficas e inclusivas para o desenvolvimento sustentável, proporcionar o acesso à justiça para todos.", "Governança"),
    (17, "Parcerias e meios de implementação", "Fortalecer os meios de implementação e revitalizar a parceria global para o desenvolvimento sustentável.", "Governança"),
    (18, "Cultura da paz e direitos humanos", "Promover a cultura de paz, o respeito aos direitos humanos e a resolução pacífica de conflitos em todos os níveis.", "Social"),
    (19, "Educação superior de qualidade, inclusiva e sustentável", "Garantir educação superior de qualidade, inclusiva e sustentável, fortalecendo ensino, pesquisa e extensão com equidade.", "Social"),
    (20, "Ciência, tecnologia e inovação para o desenvolvimento sustentável", "Fomentar a ciência, a tecnologia e a inovação como bases para o desenvolvimento sustentável e a difusão do conhecimento.", "Econômico-Social"),
]

# Descriptor phrases of each goal.
GOAL_DESCRIPTORS = {
    1: "pobreza extrema, renda per capita, vulnerabilidade social, proteção social, acesso a serviços básicos, desigualdade de renda, linha de pobreza, segurança econômica",
    2: "segurança alimentar, nutrição infantil, agricultura familiar, produtividade agrícola, sistemas alimentares sustentáveis, agroecologia, soberania alimentar, desnutrição",
    3: "mortalidade materno-infantil, doenças transmissíveis, saúde mental, cobertura universal de saúde, acesso a medicamentos, epidemias, saúde reprodutiva, vacinação",
    4: "educação básica universal, alfabetização, ensino superior, formação técnica profissional, igualdade de acesso educacional, educação para desenvolvimento sustentável, infraestrutura escolar",
    5: "empoderamento feminino, violência de gênero, participação política das mulheres, direitos reprodutivos, liderança feminina, discriminação de gênero, igualdade salarial, trabalho doméstico não remunerado",
    6: "acesso universal à água potável, saneamento básico, gestão integrada de recursos hídricos, qualidade da água, eficiência hídrica, proteção de ecossistemas aquáticos, higiene",
    7: "energias renováveis, eficiência energética, acesso universal à energia, matriz energética limpa, tecnologias sustentáveis de energia, energia solar, energia eólica, biomassa",
    8: "emprego pleno e produtivo, trabalho decente, crescimento econômico inclusivo, produtividade econômica, empreendedorismo, direitos trabalhistas, trabalho infantil, trabalho forçado",
    9: "infraestrutura resiliente, industrialização sustentável, inovação tecnológica, pesquisa e desenvolvimento, conectividade, acesso à internet, pequenas indústrias, transferência de tecnologia",
    10: "desigualdade de renda, inclusão social e econômica, migração segura e ordenada, políticas redistributivas, discriminação, igualdade de oportunidades, representação nos processos decisórios",
    11: "urbanização sustentável, habitação adequada e acessível, transporte público sustentável, gestão de resíduos urbanos, planejamento urbano participativo, patrimônio cultural e natural, espaços públicos seguros",
    12: "eficiência no uso de recursos naturais, economia circular, gestão sustentável de resíduos, práticas sustentáveis corporativas, consumo consciente, desperdício de alimentos, produtos químicos e resíduos perigosos",
    13: "mitigação climática, adaptação às mudanças climáticas, redução de emissões de gases do efeito estufa, resiliência climática, financiamento climático, educação climática, desastres relacionados ao clima",
    14: "conservação marinha e costeira, pesca sustentável, poluição oceânica, ecossistemas aquáticos, acidificação dos oceanos, biodiversidade marinha, áreas marinhas protegidas, recursos genéticos marinhos",
    15: "biodiversidade terrestre, desertificação, gestão florestal sustentável, conservação de habitats, espécies ameaçadas de extinção, degradação do solo, tráfico de fauna e flora, ecossistemas de montanha",
    16: "redução da violência, estado de direito, acesso à justiça, transparência institucional, combate à corrupção, instituições eficazes e responsáveis, participação cidadã, identidade legal universal",
    17: "cooperação internacional, assistência oficial ao desenvolvimento, financiamento para desenvolvimento, transferência de tecnologia, capacitação institucional, parcerias multissetoriais, comércio internacional justo",
    18: "direitos humanos, cultura de paz, resolução de conflitos, mediação, justiça restaurativa, educação em direitos, diversidade cultural, inclusão social",
    19: "educação superior, universidades, inclusão acadêmica, permanência estudantil, qualidade acadêmica, pesquisa e extensão, inovação pedagógica, sustentabilidade institucional",
    20: "pesquisa científica, desenvolvimento tecnológico, inovação para sustentabilidade, acesso ao conhecimento científico, formação de recursos humanos em CT&I, infraestrutura de pesquisa, propriedade intelectual, divulgação científica",
}

# Macro-categories as (name, main goals, cross-cutting goals, associated goals, focus).
MACRO_CATEGORIES = [
    (
        "Social",
        [1, 2, 3, 4, 5, 10, 18, 19],
        [],
        "ODS 1 - Erradicação da Pobreza; ODS 2 - Fome Zero e Agricultura Sustentável; ODS 3 - Saúde e Bem-Estar; ODS 4 - Educação de Qualidade; ODS 5 - Igualdade de Gênero; ODS 10 - Redução das Desigualdades; ODS 18 - Cultura da Paz e Direitos Humanos; ODS 19 - Educação Superior de Qualidade, Inclusiva e Sustentável",
        "Foco em bem-estar humano, inclusão social, igualdade de gênero e raça, formação educacional e valorização da diversidade cultural.",
    ),
    (
        "Econômica",
        [7, 8, 9, 11, 20],
        [],
        "ODS 7 - Energia Acessível e Limpa; ODS 8 - Trabalho Decente e Crescimento Econômico; ODS 9 - Indústria, Inovação e Infraestrutura; ODS 11 - Cidades e Comunidades Sustentáveis; ODS 20 - Ciência, Tecnologia e Inovação para o Desenvolvimento Sustentável",
        "Foco em crescimento sustentável, inovação, geração de emprego, infraestrutura inteligente e transformação tecnológica.",
    ),
    (
        "Ambiental",
        [6, 12, 13, 14, 15],
        [],
        "ODS 6 - Água Potável e Saneamento; ODS 12 - Consumo e Produção Responsáveis; ODS 13 - Ação Contra a Mudança Global do Clima; ODS 14 - Vida na Água; ODS 15 - Vida Terrestre",
        "Foco em conservação ambiental, uso sustentável dos recursos naturais, saneamento básico e biodiversidade.",
    ),
    (
        "Institucional / Governança",
        [16, 17],
        [18, 20],
        "ODS 16 - Paz, Justiça e Instituições Eficazes; ODS 17 - Parcerias e Meios de Implementação; ODS 18 - Cultura da Paz e Direitos Humanos (Transversal); ODS 20 - Ciência, Tecnologia e Inovação para o Desenvolvimento Sustentável (Transversal)",
        "Foco em governança democrática, cooperação interinstitucional, fortalecimento de políticas públicas e implementação dos ODS.",
    ),
]
# Macro-category of a goal outside the table above.
MACRO_DEFAULT_NAME = "Expansão Complementar"
MACRO_DEFAULT_FOCUS = "Eixos complementares definidos nas expansões dos ODS."
CATEGORY_DEFAULT = "Geral"
LAST_OFFICIAL_GOAL = 17

# Texts that stand for a missing value in the raw files.
BLANK_WORDS = ["", "nan", "NaN", "NULL", "None"]

# Further texts that a CSV reader takes for a missing value.
MISSING_WORDS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Columns that carry the place of a row in its input.
POSITION = ["_arquivo", "_bloco", "_linha"]

# Degrees that count for graduation, words that mark a graduate.
GRADUATE_DEGREES = ["MESTRADO", "DOUTORADO", "MESTRADO PROFISSIONAL", "DOUTORADO PROFISSIONAL"]
GRADUATE_STATUS_WORDS = ["TITULADO", "EGRESSO", "FORMADO", "CONCLUÍDO", "DEFENDEU"]

# Age bands as (upper bound, label), each open on the left.
AGE_BANDS = [
    (25, "ATÉ 25"),
    (35, "26-35"),
    (45, "36-45"),
    (55, "46-55"),
    (65, "56-65"),
    (100, "ACIMA DE 65"),
]

DAYS_PER_MONTH = 30.44

# Surrogate key column of each dimension.
SK_COLUMN = {
    "tempo": "tempo_sk",
    "localidade": "localidade_sk",
    "ies": "ies_sk",
    "ppg": "ppg_sk",
    "tema": "tema_sk",
    "ods": "ods_sk",
    "docente": "docente_sk",
    "discente": "discente_sk",
    "titulado": "titulado_sk",
    "posdoc": "posdoc_sk",
    "producao": "producao_sk",
}

# The column that names a member, per dimension.
NAME_COLUMN = {
    "tempo": "dia_semana",
    "localidade": "nome",
    "ies": "des_ies",
    "ppg": "nome_programa",
    "tema": "tema_nome",
    "ods": "ods_nome",
    "docente": "des_docente",
    "discente": "nome_discente",
    "titulado": "nome_titulado",
    "posdoc": "nome_posdoc",
    "producao": "titulo_producao",
}

# The unknown member (key 0) of each dimension; absent columns are null.
UNKNOWN_MEMBER = {
    "tempo": {"dia_semana": NOT_INFORMED, "fim_de_semana": "N"},
    "localidade": {
        "sigla_uf": UNKNOWN_CODE,
        "nome_uf": NOT_INFORMED,
        "regiao": NOT_INFORMED,
        "sigla_regiao": UNKNOWN_CODE,
        "nivel": NOT_INFORMED,
        "capital": 0,
        "nome": NOT_INFORMED,
    },
    "tema": {
        "macrotema_id": 0,
        "macrotema_nome": NOT_INFORMED,
        "tema_id": 0,
        "tema_nome": NOT_INFORMED,
        "palavrachave_id": 0,
        "palavra_chave": NOT_INFORMED,
        "sigla_uf": UNKNOWN_CODE,
    },
    "ods": {
        "ods_numero": 0,
        "ods_nome": NOT_INFORMED,
        "ods_descricao": "Registro para valores desconhecidos ou não aplicáveis",
        "ods_codigo": "ODS-00",
        "ods_status": NOT_INFORMED,
        "ods_categoria": NOT_INFORMED,
        "ods_macrocategoria": NOT_INFORMED,
        "ods_associados": NOT_INFORMED,
        "ods_foco_principal": NOT_INFORMED,
        "ods_tipo": NOT_INFORMED,
    },
    "ies": {
        "cod_entidade_capes": 0,
        "sg_ies": UNKNOWN_CODE,
        "des_ies": NOT_INFORMED,
        "des_status_juridico": NOT_INFORMED,
        "des_dependencia_adm": NOT_INFORMED,
        "des_regiao": NOT_INFORMED,
        "sg_uf": UNKNOWN_CODE,
        "des_municipio_programa": NOT_INFORMED,
    },
    "ppg": {
        "codigo_programa": "0",
        "nome_programa": NOT_INFORMED,
        "nota_programa": 0.0,
        "modalidade": NOT_INFORMED,
        "situacao": NOT_INFORMED,
        "programa_em_rede": NOT_INFORMED,
        "ies_vinculada": NOT_INFORMED,
        "codigo_ies": 0,
        "uf": UNKNOWN_CODE,
        "regiao": NOT_INFORMED,
        "area_conhecimento": NOT_INFORMED,
        "grande_area": NOT_INFORMED,
        "area_avaliacao": NOT_INFORMED,
        "total_cursos": 0,
        "quantidade_docentes": 0,
        "quantidade_discentes": 0,
        "ano_base": 0,
    },
    "docente": {
        "id_pessoa": "0",
        "des_docente": "Desconhecido",
        "bl_doutor": False,
        "bl_bolsa_pq": False,
        "bl_coordenador_ppg": False,
    },
    "discente": {
        "id_discente": "0",
        "id_pessoa": "0",
        "nome_discente": NOT_INFORMED,
        "tipo_documento": NOT_INFORMED,
        "numero_documento": "0",
        "sexo": NOT_INFORMED,
        "idade_ano_base": 0,
        "pais_nacionalidade": NOT_INFORMED,
        "tipo_nacionalidade": NOT_INFORMED,
        "raca_cor": NOT_INFORMED,
        "necessidade_especial": "N",
        "status_ingressante": NOT_INFORMED,
        "grau_academico": NOT_INFORMED,
        "situacao_discente": NOT_INFORMED,
        "faixa_etaria": NOT_INFORMED,
        "orientador_principal": NOT_INFORMED,
        "titulo_tese_dissertacao": NOT_INFORMED,
        "meses_para_titulacao": 0,
        "id_lattes": "0",
        "ano_base": 0,
    },
    "titulado": {
        "id_discente_original": "0",
        "id_pessoa": "0",
        "nome_titulado": NOT_INFORMED,
        "tipo_documento": NOT_INFORMED,
        "numero_documento": "0",
        "sexo": NOT_INFORMED,
        "idade_ano_base": 0,
        "pais_nacionalidade": NOT_INFORMED,
        "raca_cor": NOT_INFORMED,
        "grau_titulacao": NOT_INFORMED,
        "nivel_titulacao": NOT_INFORMED,
        "situacao_titulacao": NOT_INFORMED,
        "faixa_etaria": NOT_INFORMED,
        "orientador_principal": NOT_INFORMED,
        "titulo_trabalho_final": NOT_INFORMED,
        "meses_para_titulacao": 0,
        "anos_para_titulacao": 0.0,
        "id_lattes": "0",
        "ano_base": 0,
    },
    "posdoc": {
        "id_posdoc": "0",
        "id_pessoa": "0",
        "nome_posdoc": NOT_INFORMED,
        "tipo_documento": NOT_INFORMED,
        "numero_documento": "0",
        "sexo": NOT_INFORMED,
        "idade_ano_base": 0,
        "pais_nacionalidade": NOT_INFORMED,
        "raca_cor": NOT_INFORMED,
        "situacao_posdoc": NOT_INFORMED,
        "faixa_etaria": NOT_INFORMED,
        "orientador_principal": NOT_INFORMED,
        "area_concentracao": NOT_INFORMED,
        "meses_duracao": 0,
        "id_lattes": "0",
        "ano_base": 0,
    },
    "producao": {
        "id_producao": "0",
        "tipo_producao": "Desconhecido",
        "subtipo_producao": NOT_INFORMED,
        "titulo_producao": NOT_INFORMED,
        "ano_producao": 0,
        "nome_periodico": NOT_INFORMED,
        "pais_publicacao": "BRA",
        "idioma": NOT_INFORMED,
        "natureza_producao": NOT_INFORMED,
        "meio_divulgacao": NOT_INFORMED,
        "ano_base": "0000",
    },
}
