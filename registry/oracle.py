"""The same results in plain SQL, written from the definitions and not from the Spark plans."""

from __future__ import annotations

from registry.bindings import CORPUS_SKILLS, CVS, POSTINGS, TEXT_POSTINGS, plain
from vacantia.functions.labels import CONTRACT_WORDS, JUNIOR_WORDS, SENIOR_WORDS, TECH_WORDS
from vacantia.functions.text import ACCENTED, PLAIN
from vacantia.plans.skills import CV_SKILLS, dictionary
from vacantia.schema import POSTING_COLUMNS

P = f"p AS ({plain(POSTINGS)})"
T = f"t AS ({plain(TEXT_POSTINGS)})"

# Star with dense ids.
DATES = """d AS (SELECT row_number() OVER (ORDER BY date_full) AS date_id, date_full FROM
  (SELECT DISTINCT CAST(date_creation AS DATE) AS date_full FROM p WHERE date_creation IS NOT NULL))"""
COMPANIES = """e AS (SELECT row_number() OVER (ORDER BY nom, secteur, taille) AS entreprise_id, nom, secteur, taille FROM
  (SELECT DISTINCT coalesce(entreprise, 'Non renseigné') AS nom, coalesce(secteur, 'Non renseigné') AS secteur,
    coalesce(taille_entreprise, 'Non renseigné') AS taille FROM p))"""
PLACES = """l AS (SELECT row_number() OVER (ORDER BY ville NULLS FIRST, region NULLS FIRST, pays NULLS FIRST,
    code_postal NULLS FIRST, latitude NULLS FIRST, longitude NULLS FIRST) AS lieu_id, * FROM
  (SELECT DISTINCT coalesce(ville, 'Non renseigné') AS ville, region, coalesce(pays, 'France') AS pays, code_postal,
    latitude, longitude FROM p))"""
FULL_FACT = """f AS (SELECT p.* EXCLUDE (pays, ville, secteur), date_id, entreprise_id, lieu_id, l.pays, l.ville, e.nom,
    e.secteur, e.taille
  FROM p LEFT JOIN d ON CAST(date_creation AS DATE) = date_full
  LEFT JOIN e ON coalesce(p.entreprise, 'Non renseigné') = e.nom AND coalesce(p.secteur, 'Non renseigné') = e.secteur
    AND coalesce(taille_entreprise, 'Non renseigné') = taille
  LEFT JOIN l ON coalesce(p.ville, 'Non renseigné') = l.ville AND p.region IS NOT DISTINCT FROM l.region
    AND coalesce(p.pays, 'France') = l.pays AND p.code_postal IS NOT DISTINCT FROM l.code_postal
    AND p.latitude IS NOT DISTINCT FROM l.latitude AND p.longitude IS NOT DISTINCT FROM l.longitude)"""
STAR = f"WITH {P}, {DATES}, {COMPANIES}, {PLACES}, {FULL_FACT}"


def mean(x: str) -> str:
    return f"round(CAST(sum(CAST({x} AS DECIMAL(28,4))) AS DOUBLE) / count({x}), 0)"


def pct(part: str, whole: str) -> str:
    return f"CAST((2000 * ({part}) + ({whole})) // (2 * ({whole})) AS DOUBLE) / 10"


MEANS = f"{mean('salaire_min')} AS salaire_moyen_min, {mean('salaire_max')} AS salaire_moyen_max"
MIDDLE = "(CAST(salaire_min AS DOUBLE) + salaire_max) / 2"
PREDICTED = "CAST(salaire_predit_eur AS DECIMAL(18,2))"


def null_rows(table: str, columns: dict[str, str], extra: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS colonne, count(*) FILTER (WHERE {c} IS NULL) AS nb_nulls, "
        f"{pct(f'count(*) FILTER (WHERE {c} IS NULL)', 'count(*)')} AS pct_nulls FROM {table}"
        for name, c in columns.items())


_contract = "CASE " + " ".join(
    f"WHEN upper(trim(type_contrat)) IN ({', '.join(repr(w) for w in words)}) THEN '{label}'"
    for label, words in CONTRACT_WORDS.items()) + " ELSE 'Autre' END"

_values = ", ".join(f"({s.competence_id}, '{s.nom}', '{s.categorie}')" for s in dictionary(CORPUS_SKILLS))
S = f"s(competence_id, nom, categorie) AS (VALUES {_values})"
B = """b AS (SELECT DISTINCT offre_id, competence_id FROM t, s
  WHERE contains(lower(description), lower(nom)) OR contains(lower(titre), lower(nom)))"""
COUNTED = """c AS (SELECT competence_id, nom, categorie, count(*) AS n FROM t, s
  WHERE contains(lower(concat(titre, ' ', description)), lower(nom)) GROUP BY ALL)"""
_cv_list = "[" + ", ".join("'" + n.replace("'", "''") + "'" for n in CV_SKILLS) + "]"
CV = f"""cv AS (SELECT *, array_to_string(list_filter({_cv_list}, lambda s: contains(lower(texte_cv), s)), ',') AS competences
  FROM ({plain(CVS)}))"""

TEXT_SALARY = r"""list_filter(list_transform(regexp_extract_all(replace(replace(salaire_libelle, ' ', ''), ',', '.'),
  '\d+(?:\.\d+)?'), lambda x: CAST(x AS DOUBLE)), lambda x: x > 500)"""


def monthly(x: str) -> str:
    return f"CASE WHEN {x} > 15000 THEN ({x}) / 12 ELSE {x} END"


TARGET = monthly(f"coalesce(({MIDDLE}), salaire_min, salaire_max, list_avg({TEXT_SALARY}))")
OLD = "SELECT offre_id, titre, experience, date_creation FROM p WHERE date_creation < DATE '2000-06-01'"
NEW = "SELECT offre_id, concat('v2 ', titre) AS titre, experience, date_creation FROM p WHERE date_creation >= DATE '2000-01-01'"


def categories(x: str) -> str:
    return f"lower(trim(coalesce({x}, 'inconnu'))) AS {x}"


def flag(text: str, pattern: str, name: str) -> str:
    return f"CAST(coalesce(regexp_matches(lower({text}), '{pattern}'), false) AS INT) AS {name}"


_text = "lower(concat(titre, ' ', coalesce(rome_libelle, ''), ' ', coalesce(experience, ''), ' ', coalesce(description, '')))"

_KINDS = {"latitude": "DOUBLE", "longitude": "DOUBLE", "salaire_min": "DOUBLE", "salaire_max": "DOUBLE", "date_creation": "TIMESTAMP"}


def posting(**known: str) -> str:
    """The 22 posting columns; those not given are NULL."""
    return ", ".join(f"{known[c]} AS {c}" if c in known else f"CAST(NULL AS {_KINDS.get(c, 'VARCHAR')}) AS {c}" for c in POSTING_COLUMNS)


def same(*names: str) -> dict[str, str]:
    """Posting columns as they are; whole numbers that may be NULL as doubles."""
    return {c: f"CAST({c} AS DOUBLE)" if c.startswith("salaire_m") else c for c in names}


def whole_word(name: str) -> str:
    quoted = "".join(c if c.isalnum() or c == " " else "\\" + c for c in name.lower())
    return rf"(?:^|[^\p{{L}}\p{{N}}_]){quoted}(?:$|[^\p{{L}}\p{{N}}_])"


ALL = same(*POSTING_COLUMNS)
STAR_FACT = """offre_id, date_id, entreprise_id, lieu_id, source, titre, type_contrat, CAST(salaire_min AS DOUBLE) AS salaire_min,
    CAST(salaire_max AS DOUBLE) AS salaire_max, salaire_libelle, salaire_predit_eur, salaire_confiance,
    CAST(NULL AS TIMESTAMP) AS date_prediction, rome_code, rome_libelle, experience, description, url_offre, date_creation"""

ORACLE: dict[str, str] = {
    "salary_market": f"""{STAR} SELECT rome_libelle AS metier, coalesce(pays, 'France') AS pays,
        coalesce(ville, 'Non renseigné') AS ville, type_contrat, experience, count(*) AS nb_offres, {MEANS},
        {mean(f'coalesce(salaire_min, {PREDICTED} * 0.9)')} AS salaire_moyen_estime_min,
        {mean(f'coalesce(salaire_max, {PREDICTED} * 1.1)')} AS salaire_moyen_estime_max,
        {mean('salaire_predit_eur')} AS salaire_predit_moyen,
        round(median(coalesce({MIDDLE}, salaire_predit_eur)), 0) AS salaire_mediane
      FROM f WHERE salaire_min IS NOT NULL OR salaire_predit_eur IS NOT NULL
      GROUP BY rome_libelle, pays, ville, type_contrat, experience""",
    "kpi_global": f"""{STAR} SELECT count(*) AS total_offres, count(DISTINCT source) AS nb_sources,
        count(DISTINCT entreprise_id) AS nb_entreprises, count(DISTINCT ville) AS nb_villes,
        count(DISTINCT rome_libelle) AS nb_metiers, {MEANS}, {mean('salaire_predit_eur')} AS salaire_predit_moyen,
        count(*) FILTER (WHERE salaire_min IS NULL) AS offres_sans_salaire,
        count(salaire_predit_eur) AS offres_avec_prediction, max(date_creation) AS date_derniere_offre,
        {pct('count(salaire_min)', 'count(*)')} AS pct_salaire_connu,
        {pct('count(salaire_predit_eur)', 'count(*)')} AS pct_salaire_predite FROM f""",
    "kpi_source": f"""{STAR} SELECT source, count(*) AS nb_offres, count(DISTINCT entreprise_id) AS nb_entreprises,
        count(DISTINCT rome_libelle) AS nb_metiers, {MEANS}, count(*) - count(salaire_min) AS nb_sans_salaire,
        {pct('count(*) - count(salaire_min)', 'count(*)')} AS pct_sans_salaire,
        count(salaire_predit_eur) AS nb_avec_prediction, min(date_creation) AS date_premiere_offre,
        max(date_creation) AS date_derniere_offre, {pct('count(description)', 'count(*)')} AS pct_avec_description,
        {pct('count(experience)', 'count(*)')} AS pct_avec_experience FROM f GROUP BY source""",
    "kpi_company": f"""{STAR} SELECT nom AS entreprise, secteur, taille, count(*) AS nb_offres,
        count(DISTINCT rome_libelle) AS nb_metiers_differents, {MEANS}, max(date_creation) AS derniere_offre,
        CAST(datediff('hour', min(date_creation), max(date_creation)) // 24 AS BIGINT) AS duree_presence_jours
      FROM f GROUP BY nom, secteur, taille""",
    "weekly_trend": f"""WITH {P} SELECT date_trunc('week', date_creation) AS semaine,
        strftime(date_trunc('week', date_creation), '%Y-%m-%d') AS semaine_label, source, rome_libelle AS metier,
        count(*) AS nb_offres, {MEANS}, {mean('salaire_predit_eur')} AS salaire_predit_moyen
      FROM p WHERE date_creation >= DATE '2001-08-01' - INTERVAL 6 MONTH GROUP BY ALL""",
    "data_quality": f"{STAR} " + null_rows("f", {
        "titre": "titre", "description": "description", "salaire_min": "salaire_min",
        "salaire_predit_eur": "salaire_predit_eur", "experience": "experience", "ville": "lieu_id",
        "entreprise": "entreprise_id"}),
    "silver_quality": f"WITH {P} SELECT *, pct_nulls < 10 AS ok FROM (" + null_rows("p", {
        c: c for c in ("titre", "entreprise", "ville", "type_contrat", "date_creation")}) + ")",
    "flat_postings": f"""WITH {P} SELECT offre_id, titre, description, type_contrat, experience, CAST(salaire_min AS DOUBLE) AS salaire_min,
        CAST(salaire_max AS DOUBLE) AS salaire_max, salaire_predit_eur, salaire_confiance, rome_libelle AS metier, source, url_offre,
        date_creation, CAST(year(date_creation) AS INT) AS annee, CAST(month(date_creation) AS INT) AS mois,
        strftime(date_creation, '%Y-%m') AS annee_mois, rpad(dayname(date_creation), 9, ' ') AS jour_semaine,
        coalesce(ville, 'Non renseigné') AS ville, coalesce(region, 'Non renseigné') AS region,
        coalesce(pays, 'France') AS pays, latitude, longitude, coalesce(entreprise, 'Non renseigné') AS entreprise,
        coalesce(secteur, 'Non renseigné') AS secteur, coalesce(taille_entreprise, 'Non renseigné') AS taille_entreprise,
        CAST(salaire_min IS NOT NULL AND salaire_max IS NOT NULL AS INT) AS a_salaire_connu,
        CAST(salaire_predit_eur IS NOT NULL AS INT) AS a_salaire_predite,
        coalesce({MIDDLE}, salaire_predit_eur) AS salaire_estime FROM p""",
    "salary_fallback": f"""WITH {P}, m AS (SELECT rome_libelle, type_contrat, median({MIDDLE}) AS v FROM p
        WHERE salaire_min IS NOT NULL AND salaire_max IS NOT NULL GROUP BY ALL)
      SELECT offre_id, coalesce(v, (SELECT median({MIDDLE}) FROM p WHERE salaire_min IS NOT NULL)) AS salaire_estime_fallback
      FROM p LEFT JOIN m USING (rome_libelle, type_contrat) WHERE salaire_min IS NULL""",
    "market_stats": f"""WITH {P} SELECT 'total' AS mesure, CAST(NULL AS VARCHAR) AS libelle, count(*) AS nb_offres FROM p
      UNION ALL SELECT 'source', source, count(*) FROM p GROUP BY source
      UNION ALL (SELECT 'contrat', type_contrat, count(*) FROM p WHERE type_contrat IS NOT NULL
        GROUP BY type_contrat ORDER BY count(*) DESC, type_contrat LIMIT 5)""",
    "source_distribution": f"WITH {P} SELECT source, count(*) AS nb FROM p GROUP BY source",
    "table_counts": f"""{STAR} SELECT 'fact_offres' AS table_name, count(*) AS nb_lignes FROM f
      UNION ALL SELECT 'dim_date', count(*) FROM d UNION ALL SELECT 'dim_entreprise', count(*) FROM e
      UNION ALL SELECT 'dim_lieu', count(*) FROM l
      UNION ALL SELECT 'vw_entreprises_kpi', count(DISTINCT (nom, secteur, taille)) FROM f""",
    "dim_date": f"""WITH {P}, {DATES} SELECT date_id, CAST(date_full AS VARCHAR) AS date_full, CAST(year(date_full) AS INT) AS annee,
        CAST(month(date_full) AS INT) AS mois, CAST(weekofyear(date_full) AS INT) AS semaine,
        rpad(dayname(date_full), 9, ' ') AS jour_semaine FROM d""",
    "dim_company": f"WITH {P}, {COMPANIES} SELECT * FROM e",
    "dim_place": f"WITH {P}, {PLACES} SELECT * FROM l",
    "fact_full_key": f"{STAR} SELECT {STAR_FACT} FROM f",
    "fact_name_key": f"""WITH {P}, {DATES}, {COMPANIES}, {PLACES}
      SELECT {STAR_FACT}
      FROM p LEFT JOIN d ON CAST(date_creation AS DATE) = date_full
      LEFT JOIN e ON coalesce(entreprise, 'Non renseigné') = nom
      LEFT JOIN l ON coalesce(p.ville, 'Non renseigné') = l.ville AND coalesce(p.pays, 'France') = l.pays""",
    "staging": f"""WITH {P} SELECT {posting(**{k: v for k, v in ALL.items() if k != "region"})}, CAST(length(offre_id) AS INT) AS extra FROM p
      WHERE experience IS NULL OR experience <> '1-URGENT'""",
    "fact_incremental": f"""WITH {P} SELECT offre_id, source, titre, CAST(salaire_min AS DOUBLE) AS salaire_min, date_creation FROM p
      WHERE offre_id NOT IN (SELECT offre_id FROM p WHERE date_creation < DATE '2000-06-01')""",
    "insert_new": f"""WITH {P}, o AS ({OLD}), n AS ({NEW}) SELECT * FROM o
      UNION ALL SELECT * FROM n WHERE offre_id NOT IN (SELECT offre_id FROM o)""",
    "replace_batch": f"""WITH {P}, o AS ({OLD}), n AS ({NEW}) SELECT * FROM n
      UNION ALL SELECT * FROM o WHERE offre_id NOT IN (SELECT offre_id FROM n)""",
    "schema_sync": f"""WITH {P}, o AS ({OLD}), n AS ({NEW})
      SELECT offre_id, titre, date_creation, CAST(NULL AS DOUBLE) AS niveau FROM o
      UNION ALL SELECT offre_id, titre, date_creation, CAST(length(titre) AS DOUBLE) FROM n""",
    "prediction_update": f"""WITH {P}, f AS (SELECT offre_id, salaire_min, salaire_predit_eur,
        CASE rome_code WHEN '1' THEN 'basse (fallback)' WHEN '2' THEN 'haute' END AS c,
        CASE WHEN pays IS NOT NULL THEN CAST(length(titre) AS DOUBLE) END AS new FROM p),
      g AS (SELECT *, new IS NOT NULL AND salaire_min IS NULL AND
        (salaire_predit_eur IS NULL OR coalesce(c, '') = 'basse (fallback)') AS modifie FROM f)
      SELECT offre_id, CAST(salaire_min AS DOUBLE) AS salaire_min, CASE WHEN modifie THEN new ELSE salaire_predit_eur END AS salaire_predit_eur,
        CASE WHEN modifie THEN 'moyenne' ELSE c END AS salaire_confiance,
        CASE WHEN modifie THEN TIMESTAMP '2024-01-01' END AS date_prediction, modifie FROM g""",
    "gold_source": f"""WITH {P}, g AS (SELECT source, pays, count(offre_id) AS nb_offres FROM p GROUP BY ALL)
      SELECT coalesce(source, 'inconnu') AS source, coalesce(pays, 'Non renseigné') AS pays, nb_offres FROM g""",
    "gold_contract": f"WITH {P} SELECT coalesce(type_contrat, 'Non renseigné') AS type_contrat, count(*) AS nb_offres FROM p GROUP BY ALL",
    "gold_city": f"""WITH {P} SELECT ville, pays, count(*) AS nb_offres FROM p WHERE ville IS NOT NULL GROUP BY ALL
      ORDER BY nb_offres DESC, ville, pays NULLS FIRST LIMIT 30""",
    "gold_salary": f"""WITH {P} SELECT source, round_even(avg(salaire_min), 0) AS salaire_min_moyen,
        round_even(avg(salaire_max), 0) AS salaire_max_moyen, count(offre_id) AS nb_offres_avec_salaire
      FROM p WHERE salaire_min > 0 GROUP BY source""",
    "gold_month": f"""WITH {P} SELECT strftime(date_creation, '%Y-%m') AS annee_mois, source, count(*) AS nb_offres
      FROM p GROUP BY ALL""",
    "gold_sector": f"""WITH {P} SELECT secteur, count(*) AS nb_offres FROM p WHERE secteur IS NOT NULL GROUP BY ALL
      ORDER BY nb_offres DESC, secteur LIMIT 20""",
    "contract_norm": f"WITH {P} SELECT offre_id, {_contract} AS type_contrat FROM p",
    "salary_text": rf"""WITH {P}, r AS (SELECT offre_id, salaire_libelle,
        regexp_extract(salaire_libelle, '(\d[\d\s]*)\s*[-–]\s*(\d[\d\s]*)', 1) AS a,
        regexp_extract(salaire_libelle, '(\d[\d\s]*)\s*[-–]\s*(\d[\d\s]*)', 2) AS b,
        list_avg({TEXT_SALARY}) AS m FROM p)
      SELECT offre_id, CAST(TRY_CAST(regexp_replace(a, '\s', '', 'g') AS INT) AS DOUBLE) AS bas,
        CAST(TRY_CAST(regexp_replace(b, '\s', '', 'g') AS INT) AS DOUBLE) AS haut, round({monthly('m')}, 2) AS mensuel FROM r""",
    "salary_target": f"""WITH {P} SELECT offre_id, round({TARGET}, 2) AS cible,
        coalesce({MIDDLE}, salaire_predit_eur) AS estime FROM p""",
    "clean_title": r"""SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS propre,
        md5(lower(regexp_replace(text, '[^a-zA-Z0-9À-ɏ ]', '', 'g'))) AS norme,
        md5(concat(lang, '|', chr(0), '|', source)) AS cle FROM documents""",
    "dedup_latest": "SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1",
    "dedup_cross_source": f"""WITH {T} SELECT offre_id, source FROM t QUALIFY row_number() OVER (
        PARTITION BY lower(regexp_replace(titre, '[^a-zA-Z0-9À-ɏ ]', '', 'g')), pays, ville
        ORDER BY CASE source WHEN 'src3' THEN 0 WHEN 'src1' THEN 1 WHEN 'src2' THEN 2 ELSE 3 END, offre_id) = 1""",
    "conform_union": f"""WITH {P} SELECT {posting(**ALL | {
        "experience": "CASE WHEN source <> 'src_a' THEN experience END", "region": "CASE WHEN source <> 'src_b' THEN region END",
        "pays": "CASE WHEN source <> 'src_b' THEN pays END", "salaire_max": "CASE WHEN source <> 'src_c' THEN CAST(salaire_max AS DOUBLE) END"})}
      FROM p WHERE length(titre) > 3""",
    "conform_listing": f"""WITH {P} SELECT {posting(**same(
        "offre_id", "titre", "description", "ville", "region", "latitude", "longitude", "entreprise", "secteur", "salaire_min", "url_offre"),
        type_contrat=_contract, pays="'France'", source="'adzuna'", date_creation="CASE WHEN rome_code <> '3' THEN date_creation END",
        salaire_max="CAST(CASE WHEN salaire_max <= 2147 THEN salaire_max * 1000000 END AS DOUBLE)")} FROM p WHERE length(titre) > 3""",
    "conform_labour": rf"""WITH {P}, r AS (SELECT * EXCLUDE (salaire_min, salaire_max), regexp_extract(salaire_libelle, '(\d+) - (\d+)', 1) AS a,
        regexp_extract(salaire_libelle, '(\d+) - (\d+)', 2) AS b FROM p)
      SELECT {posting(**same(
        "offre_id", "titre", "experience", "description", "ville", "code_postal", "latitude", "longitude", "entreprise", "secteur",
        "salaire_libelle", "date_creation"), type_contrat=_contract, pays="'France'", source="'france_travail'",
        salaire_min="TRY_CAST(a AS DOUBLE)", salaire_max="TRY_CAST(b AS DOUBLE)")} FROM r""",
    "conform_lenient": f"""WITH {P} SELECT {posting(**same("offre_id", "titre", "type_contrat", "ville", "salaire_min"),
        pays="'France'", source="'adzuna'")} FROM p WHERE length(titre) > 3""",
    "partitioned_roundtrip": f"WITH {P} SELECT * REPLACE (CAST(salaire_min AS DOUBLE) AS salaire_min, CAST(salaire_max AS DOUBLE) AS salaire_max) FROM p",
    "landing_stream": f"WITH {P} SELECT {posting(**ALL)} FROM p",
    "conform_scraped": f"""WITH {P} SELECT {posting(**same("titre", "experience", "region", "entreprise", "secteur", "date_creation"),
        type_contrat=_contract, ville="region", pays="'Maroc'", source="'emploima'", url_offre="coalesce(CASE WHEN rome_code <> '1' THEN url_offre END, url_offre)",
        offre_id="md5(concat(titre, '|', coalesce(entreprise, chr(0)), '|', url_offre))")} FROM p WHERE length(titre) > 3""",
    "sanitise": f"""WITH {P} SELECT {posting(
        **same("offre_id", "titre", "ville", "longitude"), pays="CASE WHEN pays IN ('ASIA', 'AFRICA') THEN NULL ELSE left(repeat(pays, 20), 50) END",
        salaire_min="CAST(CASE WHEN salaire_min % 3 = 0 THEN salaire_min WHEN salaire_min % 3 = 1 AND salaire_min <= 2147 THEN salaire_min * 1000000 END AS DOUBLE)",
        date_creation="CASE WHEN rome_code <> '2' THEN date_creation END")} FROM p""",
    "envelope_roundtrip": "SELECT event_id, user_id, value, props, event_type AS source FROM events",
    "flatten_nested": "SELECT event_id, user_id AS user_id, event_type AS user_action_type, value AS user_action_value FROM events",
    "html_cards": r"""WITH c AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<article\b[^>]*>(.*?)</article>', 1)) AS card,
        generate_subscripts(regexp_extract_all(html, '(?is)<article\b[^>]*>(.*?)</article>', 1), 1) - 1 AS position FROM pages)
      SELECT page_id, CAST(position AS INT) AS position, trim(replace(replace(replace(replace(regexp_replace(
        regexp_extract(card, '(?is)<h1\b[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
        '&amp;', '&')) AS titre, 'Non precise' AS entreprise, 'Non precise' AS region, '' AS url_offre FROM c""",
    "html_links": r"""WITH c AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul>', 1)) AS card,
        generate_subscripts(regexp_extract_all(html, '(?is)<ul\b[^>]*>(.*?)</ul>', 1), 1) - 1 AS position FROM pages)
      SELECT page_id, CAST(position AS INT) AS position,
        trim(regexp_replace(regexp_extract(card, '(?is)<li\b[^>]*>(.*?)</li>', 1), '<[^>]*>', '', 'g')) AS titre,
        concat('https://site.example', regexp_extract(card, 'href="([^"]*)"', 1)) AS url_offre FROM c""",
    "raw_field_profile": """SELECT key AS champ, count(*) AS nb_lignes, count(*) FILTER (WHERE json_type(props, key) <> 'NULL') AS nb_remplis,
        'BIGINT' AS type, CAST(100 AS DOUBLE) AS pct_remplis
      FROM (SELECT props, unnest(json_keys(props)) AS key FROM events) GROUP BY key""",
    "skill_bridge": f"WITH {T}, {S}, {B} SELECT offre_id, CAST(competence_id AS INT) AS competence_id, 'description' AS source_champ FROM b",
    "skill_top": f"""WITH {T}, {S}, {B} SELECT nom AS competence, categorie, count(DISTINCT offre_id) AS nb_offres,
        {pct('count(DISTINCT offre_id)', '(SELECT count(*) FROM t)')} AS pct_offres, {MEANS},
        {mean('salaire_predit_eur')} AS salaire_predit_moyen
      FROM b JOIN s USING (competence_id) LEFT JOIN t USING (offre_id) GROUP BY nom, categorie""",
    "skill_demand": f"""WITH {T}, {S}, {B} SELECT nom AS competence, categorie, count(DISTINCT offre_id) AS nb_offres_detectees
      FROM s LEFT JOIN b USING (competence_id) GROUP BY competence_id, nom, categorie""",
    "skill_summary": f"""WITH {T}, {S}, {COUNTED} SELECT CAST(row_number() OVER (ORDER BY competence_id) AS INT) AS competence_id,
        nom, categorie, n AS nb_offres FROM c""",
    "skill_categories": f"WITH {T}, {S}, {COUNTED} SELECT categorie, count(*) AS nb FROM c GROUP BY categorie",
    "skill_matrix": f"""WITH {T}, {S}, {B} SELECT offre_id, titre, rome_libelle AS metier, source, type_contrat, experience,
        nom AS competence, categorie, CAST(salaire_min AS DOUBLE) AS salaire_min, CAST(salaire_max AS DOUBLE) AS salaire_max,
        salaire_predit_eur, salaire_confiance, coalesce(ville, 'Non renseigné') AS ville, pays, entreprise, secteur
      FROM b JOIN s USING (competence_id) JOIN t USING (offre_id)""",
    "cv_skills": f"WITH {CV} SELECT candidat_id, competences FROM cv",
    "candidate_skills": f"""WITH {CV} SELECT candidat_id, nom, prenom, email, unnest(string_split(competences, ',')) AS competence,
        CAST(length(texte_cv) AS INT) AS taille_cv FROM cv WHERE competences <> ''""",
    "candidate_lookup": f"""WITH {CV} SELECT candidat_id, email, competences FROM cv
      WHERE conv_id IN (SELECT conv_id FROM conversations WHERE turn >= 2)""",
    "candidate_upsert": f"""WITH {CV}, first AS (SELECT * FROM cv WHERE turn = 0),
      last AS (SELECT * FROM cv WHERE turn > 0 QUALIFY row_number() OVER (PARTITION BY email ORDER BY turn DESC) = 1)
      SELECT coalesce(CAST(first.candidat_id AS VARCHAR), 'hash') AS candidat_id, email, coalesce(last.nom, first.nom) AS nom, coalesce(last.prenom, first.prenom) AS prenom,
        md5(coalesce(last.texte_cv, first.texte_cv)) AS cv, coalesce(last.competences, first.competences) AS competences,
        CAST(CAST(coalesce(first.updated_at, last.updated_at) AS DATE) AS VARCHAR) AS created_at,
        CAST(CAST(coalesce(last.updated_at, first.updated_at) AS DATE) AS VARCHAR) AS updated_at
      FROM first FULL JOIN last USING (email)""",
    "recommend_topk": """WITH s AS (SELECT q.vec_id AS candidat_id, i.vec_id AS offre_id,
        list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(i.embedding AS DOUBLE[])) AS score
        FROM embeddings q, embeddings i),
      r AS (SELECT *, row_number() OVER (PARTITION BY candidat_id ORDER BY round(score, 9) DESC, offre_id) AS rang FROM s)
      SELECT candidat_id, offre_id, CAST(rang AS INT) AS rang, round(score, 9) AS score FROM r WHERE rang <= 10""",
    "vector_refresh": f"""WITH {T} SELECT offre_id, sha256(concat(titre, ' ', description)) AS texte_hash FROM t
      WHERE pays IN ('es', 'de')""",
    "explain_match": f"""WITH {T}, {CV}, m AS (SELECT candidat_id, offre_id, turn + 1 AS rang, CAST(length(description) % 997 AS DOUBLE) / 1000 AS score,
          CASE WHEN competences = '' THEN [] ELSE string_split(competences, ',') END AS own,
          lower(concat(description, ' ', titre)) AS txt
        FROM cv JOIN t ON CAST(offre_id AS BIGINT) % (SELECT count(DISTINCT conv_id) FROM conversations) = conv_id),
      x AS (SELECT *, list_filter(own, lambda s: contains(txt, s))[1:3] AS good,
          list_filter({_cv_list}, lambda s: contains(txt, s) AND NOT list_contains(own, s))[1:2] AS bad FROM m)
      SELECT candidat_id, offre_id, rang,
        CASE WHEN rang <= 5 THEN CASE WHEN len(good) = 0 THEN 'Profil pertinent' ELSE array_to_string(list_transform(good,
          lambda s: concat('Compétence ''', s, ''' requise et présente')), '; ') END END AS forts,
        CASE WHEN rang <= 5 THEN concat('Score de ', CAST(round_even(100 * score, 1) AS VARCHAR), '% — candidature recommandée !') END AS conseil,
        CASE WHEN rang <= 5 THEN CASE WHEN len(bad) = 0 THEN 'Personnaliser la candidature' ELSE array_to_string(
          list_transform(bad, lambda s: concat('À acquérir : ''', s, '''')), '; ') END END AS ameliorer FROM x""",
    "salary_features": f"""WITH {P}, {T}, a AS (SELECT * FROM p UNION ALL BY NAME SELECT * FROM t)
      SELECT offre_id, md5({_text}) AS texte, {categories('pays')}, {categories('type_contrat')}, {categories('source')},
        {categories('secteur')}, {categories('taille_entreprise')}, {flag('titre', SENIOR_WORDS, 'is_senior')},
        {flag('titre', JUNIOR_WORDS, 'is_junior')}, {flag(_text, TECH_WORDS, 'has_tech')}, round({TARGET}, 2) AS cible FROM a""",
    "confidence_levels": f"""WITH {P}, c AS (SELECT offre_id, CAST(pays IS NOT NULL AS INT) + CAST(experience IS NOT NULL AS INT)
        + CAST(secteur IS NOT NULL AS INT) + CAST(length(coalesce(description, '')) > 100 AS INT) AS n FROM p)
      SELECT offre_id, CASE WHEN n >= 3 THEN 'haute' WHEN n >= 2 THEN 'moyenne' ELSE 'basse' END AS confiance FROM c""",
}
ORACLE["skill_top_joined"] = ORACLE["skill_top"]
LANDED = f"""{P}, k AS (SELECT *, CAST(offre_id AS BIGINT) AS k FROM p), v AS (SELECT *, k % 50 = 1 AS bad, k % 50 <> 1 AND k % 5 = 2 AS odd FROM k)"""
ORACLE |= {
    "partitioned_rebuild": f"""WITH {P} SELECT * REPLACE (CAST(salaire_min AS DOUBLE) AS salaire_min, CAST(salaire_max AS DOUBLE) AS salaire_max)
      FROM p WHERE source = 'src_a' AND pays IS NOT NULL""",
    "lenient_labour": f"""WITH {P} SELECT {posting(**same("offre_id", "titre", "type_contrat", "ville", "latitude", "salaire_libelle", "rome_code",
        "date_creation"), pays="'France'", source="'france_travail'")} FROM p WHERE length(titre) > 3""",
    "lenient_scraped": f"""WITH {P} SELECT {posting(**same("titre", "entreprise", "experience", "type_contrat", "region", "url_offre", "date_creation"),
        offre_id="md5(concat(titre, '|', coalesce(entreprise, chr(0)), '|', url_offre))", pays="'Maroc'", source="'emploima'")} FROM p""",
    "landed_records": f"""WITH {LANDED} SELECT offre_id, titre, latitude, CASE WHEN NOT odd THEN CAST(salaire_min AS DOUBLE) END AS salaire_min,
        CASE WHEN NOT odd THEN entreprise END AS entreprise FROM v WHERE NOT bad""",
    "landed_files": f"""WITH {LANDED} SELECT source AS dossier, true AS lisible, count(DISTINCT k // 1000) AS nb_fichiers,
        CAST(count(*) FILTER (WHERE NOT bad) AS BIGINT) AS nb_lues, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS nb_rejetees FROM v GROUP BY source
      UNION ALL SELECT unnest(['cut', 'blank']), false, 1, 0, 0""",
    "skill_words": f"WITH {T}, x AS MATERIALIZED (SELECT offre_id, concat(lower(titre), chr(10), lower(description)) AS txt FROM t) " + " UNION ALL ".join(
        f"SELECT offre_id, CAST({k.competence_id} AS INT) AS competence_id FROM x WHERE regexp_matches(txt, '{whole_word(k.nom)}')"
        for k in dictionary(CORPUS_SKILLS)),
    "vector_store": f"""WITH {T} SELECT offre_id, CAST(512 AS BIGINT) AS taille, (SELECT count(*) FROM t WHERE pays <> 'es') AS premiers,
        (SELECT count(*) FROM t WHERE pays IN ('es', 'de')) AS ensuite FROM t""",
    "candidate_table": f"""WITH {CV}, x AS (SELECT * FROM cv QUALIFY row_number() OVER (PARTITION BY email ORDER BY turn DESC) = 1)
      SELECT email, nom, prenom, md5(texte_cv) AS cv, competences FROM x""",
}


def shown(c: str) -> str:
    return f"coalesce(trim({c}), 'Non precise')"


ORACLE["job_cards"] = f"""WITH {P}, k AS (SELECT *, CAST(offre_id AS BIGINT) AS k FROM p)
  SELECT k // 5 AS page_id, CAST(row_number() OVER (PARTITION BY k // 5 ORDER BY k) - 1 AS INT) AS position, concat(titre, ' & co') AS titre,
    {shown('entreprise')} AS entreprise, {shown('taille_entreprise')} AS niveau_etudes, {shown('experience')} AS experience,
    {shown('type_contrat')} AS type_contrat, {shown('region')} AS region, {shown('secteur')} AS competences,
    strftime(date_creation, '%d.%m.%Y') AS date_publication, concat('https://www.emploi.ma/offre/', offre_id) AS url_offre,
    'emploima' AS source, 'Maroc' AS pays, {shown('region')} AS ville FROM k"""
ORACLE["salary_terms"] = f"""WITH {T},
  f AS (SELECT offre_id, translate({_text}, '{ACCENTED}', '{PLAIN}') AS txt FROM t),
  w AS (SELECT offre_id, regexp_extract_all(lower(txt), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}') AS w FROM f),
  a AS (SELECT offre_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])))) AS term FROM w),
  v AS (SELECT term, count(DISTINCT offre_id) AS df FROM a GROUP BY term ORDER BY count(*) DESC, term LIMIT 300),
  c AS (SELECT offre_id, term, (1 + ln(count(*))) * (1 + ln(((SELECT count(*) FROM t) + 1) / (any_value(df) + 1))) AS x FROM a JOIN v USING (term)
    GROUP BY offre_id, term)
  SELECT offre_id, term, round(x / sqrt(sum(x * x) OVER (PARTITION BY offre_id)), 6) AS weight FROM c"""


def standardised(c: str) -> str:
    return f"coalesce(round(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 6), 0) AS {c}"


ORACLE["salary_flags"] = f"""WITH {P}, r AS (SELECT * REPLACE (concat(titre, CASE WHEN CAST(offre_id AS BIGINT) % 3 = 0 THEN ' senior' ELSE '' END,
    CASE WHEN CAST(offre_id AS BIGINT) % 7 = 0 THEN ' junior' ELSE '' END, CASE WHEN CAST(offre_id AS BIGINT) % 5 = 0 THEN ' python' ELSE '' END) AS titre) FROM p),
  f AS (SELECT offre_id, {flag('titre', SENIOR_WORDS, 'is_senior')}, {flag('titre', JUNIOR_WORDS, 'is_junior')},
    {flag(_text, TECH_WORDS, 'has_tech')} FROM r)
  SELECT offre_id, {", ".join(standardised(c) for c in ("is_senior", "is_junior", "has_tech"))} FROM f"""

ORACLE["incremental_landing"] = f"""WITH {P}, k AS (SELECT *, CAST(offre_id AS BIGINT) // 1000 AS k FROM p)
  SELECT offre_id, CASE WHEN k % 6 = 0 THEN concat('v2 ', titre) ELSE titre END AS titre, latitude, CAST(salaire_min AS DOUBLE) AS salaire_min,
    entreprise, CAST(CASE WHEN k % 6 = 0 THEN 2 ELSE 1 END AS BIGINT) AS lectures
  FROM k WHERE k % 6 <> 0 OR CAST(offre_id AS BIGINT) % 2 = 0"""
ORACLE["table_commits"] = f"""WITH {P}, o AS (SELECT offre_id, titre, strftime(date_creation, '%Y-%m') AS mois FROM ({OLD})),
    n AS (SELECT offre_id, titre, strftime(date_creation, '%Y-%m') AS mois FROM ({NEW}) WHERE CAST(offre_id AS BIGINT) % 3 = 0),
    v AS (SELECT 1 AS version, * FROM o WHERE mois < '1996' UNION ALL SELECT 2, * FROM o
      UNION ALL SELECT 3, * FROM o WHERE offre_id NOT IN (SELECT offre_id FROM n) UNION ALL SELECT 3, * FROM n)
  SELECT CAST(version AS INT) AS version, mois, count(*) AS n, count(*) FILTER (WHERE starts_with(titre, 'v2')) AS remplaces,
    CAST(sum(CAST(offre_id AS BIGINT)) AS BIGINT) AS somme FROM v GROUP BY version, mois"""

ORACLE["skill_large_dictionary"] = f"""WITH {T}, names AS (SELECT unnest({[s.nom.lower() for s in dictionary(CORPUS_SKILLS)]!r}) AS nom
    UNION SELECT w FROM (SELECT unnest(string_split(lower(text), ' ')) AS w FROM benchmark) WHERE length(w) BETWEEN 2 AND 9),
  n AS (SELECT nom, CAST('0x' || left(md5(nom), 13) AS BIGINT) AS id FROM names),
  x AS MATERIALIZED (SELECT offre_id, concat(lower(titre), chr(10), lower(description)) AS txt FROM t)
  SELECT offre_id, count(*) AS n, CAST(sum(id % 1000003) AS BIGINT) AS somme FROM x JOIN n ON contains(txt, nom) GROUP BY offre_id"""

ORACLE["recommend_pruned"] = ORACLE["recommend_topk"]

ORACLE["sanitise_rejects"] = f"""WITH {P} SELECT 'salaire_min' AS colonne, count(*) FILTER (WHERE salaire_min % 3 = 1 AND salaire_min >= 2148) AS nb_rejetees FROM p
  UNION ALL SELECT 'date_creation', count(*) FILTER (WHERE rome_code = '2') FROM p UNION ALL SELECT 'longitude', 0"""
ORACLE["colliding_keys"] = f"""WITH {P} SELECT coalesce(ville, 'Non renseigné') AS ville, region, coalesce(pays, 'France') AS pays, code_postal,
    latitude, longitude, count(*) AS nb_offres FROM p GROUP BY ALL"""
ORACLE["weekly_stream"] = f"""WITH {P} SELECT strftime(date_trunc('week', date_creation), '%Y-%m-%d') AS semaine, source, rome_libelle AS metier,
    count(*) AS nb_offres, {MEANS} FROM p GROUP BY ALL"""

# The kept aggregates are the plain ones over the postings with the predictions of prediction_update written.
_predicted = """p AS (SELECT * REPLACE (CASE WHEN pays IS NOT NULL AND salaire_min IS NULL AND salaire_predit_eur IS NULL
    THEN CAST(length(titre) AS DOUBLE) ELSE salaire_predit_eur END AS salaire_predit_eur) FROM p0)"""
for _kept, _plain in (("kept_global", "kpi_global"), ("kept_source", "kpi_source"), ("kept_company", "kpi_company"), ("kept_trend", "weekly_trend")):
    ORACLE[_kept] = ORACLE[_plain].replace(P, f"p0 AS ({plain(POSTINGS)}), {_predicted}")
