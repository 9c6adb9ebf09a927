"""The SQL that each query must agree with, for DuckDB on the same tables.

Built from shared common table expressions. Texts are cleaned once per document here,
where the queries clean them per survey row.
"""

from __future__ import annotations


ORACLES: dict[str, str] = {}

#: What the queries are told, written down once more so that a slip there shows here.
USER_HEAD, USER_TAIL = "Report:\n", "\n\nKinds, as JSON:"
SYSTEM_CHARS, N_RULES, N_CODES, N_EXAMPLES = 331, 2, 4, 1
BATCH_SIZE, MIN_COUNT, MIN_PERCENT, LOOSE_COUNT, LOOSE_PERCENT = 350, 10, 5.0, 3, 0.3
# Words that keep a phrase from being removed
KEPT_WORDS = (
    "ROBO", "ROBO,", "ROBARON", "ROBAN", "ROBAR", "ROBADO", "ROBADA", "ROBOS",
    "HURTO", "HURTARON", "HURTAN", "HURTAR", "HURTADO", "HURTADA", "HURTOS",
    "SALTO", "SALTARON", "SALTAN", "SALTAR", "SALTADO", "SALTADA", "SALTOS",
    "OFENSA", "OFENSAS", "INTENTO", "INTENTARON", "ESTAFA",
)

WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
WORD, NOT_WORD = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_]"
LETTERS = "A-Za-zÁÉÍÓÚÜÑáéíóúüñ"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '{WS}+', ' ', 'g')")


def clean(x: str) -> str:
    t = f"coalesce({x}, '')"
    t = strip(f"(regexp_replace(substring({t}, 1, 60), '\\p{{Nd}}', '', 'g') || substring({t}, 61))")
    dotted = rf"(?i)(^|{NOT_WORD})(?:P|PREG|PGR|PRG)\.({WORD})"
    plain = (
        rf"(?i)(^|{NOT_WORD})(?:P_?|ITEM|PREG|PGR|PRG|CAPÍTULO|ITEN|PGTA|I|ALTERNATIVA)"
        rf"($|{NOT_WORD})"
    )
    for pattern in (dotted, dotted, plain, plain, plain):
        t = f"regexp_replace({t}, '{pattern}', '\\1\\2', 'g')"
    t = f"regexp_replace({t}, '^[^{LETTERS}0-9]+', '')"
    return strip(f"regexp_replace({t}, '{WS}{{2,}}', ' ', 'g')")


def gate(c: str) -> str:
    return f"(length({c}) >= 21 AND len(regexp_extract_all({c}, '[{LETTERS}]+')) >= 5)"


# ---- shared steps ------------------------------------------------------------------

CTE: dict[str, tuple[list[str], str]] = {}


def cte(name: str, needs: list[str], sql: str) -> None:
    CTE[name] = (needs, sql)


def with_ctes(names: list[str], body: str, replaced: dict[str, str] | None = None) -> str:
    """The body behind the steps it needs; ``replaced`` has another SQL for some of them."""
    order: list[str] = []
    texts = {n: sql for n, (_, sql) in CTE.items()} | (replaced or {})

    def visit(n: str) -> None:
        for m in CTE[n][0]:
            visit(m)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    steps = ",\n".join(f"{n} AS MATERIALIZED ({texts[n]})" for n in order)
    return f"WITH {steps}\n{body}" if order else body


def oracle(name: str, needs: list[str], body: str, replaced: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_ctes(needs, body, replaced)


cte(
    "docs", [],
    f"SELECT doc_id, lang, text, {clean('text')} AS t FROM documents",
)
cte(
    "survey", ["docs"],
    """SELECT o.o_orderkey, o.o_custkey AS h, o.o_orderkey % 2 AS p, (o.o_orderkey // 2) % 2 AS i,
       CASE WHEN o.o_orderkey % 50 <> 0 THEN CAST(day(o.o_orderdate) AS BIGINT) END AS code,
       d.text AS original, d.t
FROM (SELECT *, (o_custkey + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END)
             % (SELECT count(*) FROM documents) AS doc_id FROM orders) o
JOIN docs d ON d.doc_id = o.doc_id""",
)


def hot_survey(code: str) -> dict[str, str]:
    """A third of the rows in one household with one narrative."""
    hot = f"""SELECT o_orderkey, 0 AS h, 0 AS p, 0 AS i, CAST({code} AS BIGINT) AS code, d.text AS original, d.t
FROM orders, docs d WHERE d.doc_id = 0 AND o_orderkey % 3 = 0"""
    return {"survey": f"{CTE['survey'][1]} WHERE o.o_orderkey % 3 <> 0 UNION ALL {hot}"}


cte(
    "keyed", ["survey"],
    """SELECT *, h || '-' || p || '-' || i AS base,
       h || '-' || p || '-' || i || '-' || coalesce(CAST(code AS VARCHAR), 'NULO') AS row_id
FROM survey""",
)
cte("valid", ["keyed"], f"SELECT * FROM keyed WHERE {gate('t')}")
cte(
    "grp", ["valid"],
    """SELECT base, t, any_value(h) AS h,
       coalesce(list_sort(list(DISTINCT CAST(code AS VARCHAR)) FILTER (code IS NOT NULL)),
                CAST([] AS VARCHAR[])) AS codes,
       list_sort(list(DISTINCT row_id)) AS ids
FROM valid GROUP BY base, t""",
)
cte(
    "given", ["grp"],
    """SELECT *, CASE WHEN h % 11 = 0 THEN CAST([] AS VARCHAR[])
            WHEN h % 7 = 0 THEN ['30']
            WHEN h % 23 = 0 THEN ['99']
            WHEN h % 29 = 0 THEN list_append(codes[1:greatest(len(codes) - 1, 0)], '99')
            WHEN h % 3 = 0 THEN list_append(codes, '99')
            ELSE codes END AS pred,
       '1. Leo el caso ' || h || '.' ||
       CASE h % 5 WHEN 0 THEN ' 4. No hay más eventos delictivos en la observación. 5. Construyo el JSON final con lo hallado.'
                  WHEN 1 THEN ' 4. Otro hecho aparte. 5. Construyo el JSON final.'
                  WHEN 2 THEN ' 4. no hay otros eventos delictivos mencionados en la observación, nada.'
                  ELSE '' END ||
       CASE WHEN h % 19 = 0 THEN ' Fallback' ELSE '' END AS reasoning
FROM grp""",
)
cte(
    "payload", ["given"],
    """SELECT *, '{"razonamiento":"' || reasoning || '","clasificaciones":' || listed || '}' AS pay
FROM (SELECT *, '[' || array_to_string(list_transform(pred, lambda c: '{"codigo":' ||
        CASE WHEN h % 5 <> 2 THEN '"' || c || '"' ELSE c END ||
        CASE WHEN h % 31 <> 4 THEN ',"justificacion":"por ' || c || '"' ELSE '' END || '}'), ',')
        || ']' AS listed FROM given)""",
)
cte(
    "answers", ["payload"],
    """SELECT base AS id, h, t, codes, ids, reasoning,
       CASE h % 13 WHEN 0 THEN substring(pay, 1, length(pay) - 3)
                   WHEN 1 THEN 'Respuesta: ' || pay
                   WHEN 2 THEN pay || 'x'
                   WHEN 3 THEN listed
                   WHEN 4 THEN ''
                   WHEN 5 THEN '5'
                   ELSE pay END AS raw
FROM payload""",
)

EMBEDDED = r'(?s)\{.*?"clasificaciones":\s*\[.*?\]\s*\}'
LISTED = (
    "list_sort(list_filter(json_extract_string({0}, '$.clasificaciones[*].codigo'), "
    "lambda c: c IS NOT NULL))"
)
cte(
    "shape", ["answers"],
    f"""SELECT *, TRY_CAST(raw AS JSON) IS NOT NULL AND json_valid(raw) AS ok,
       CASE WHEN json_valid(raw) THEN json_type(raw) END AS kind,
       regexp_extract(raw, '{EMBEDDED}') AS emb
FROM answers""",
)
cte(
    "parsed", ["shape"],
    f"""SELECT *, coalesce(ok AND kind <> 'OBJECT', false) AS failed,
  CASE WHEN ok AND kind <> 'OBJECT' THEN CAST([] AS VARCHAR[])
       WHEN ok THEN {LISTED.format('raw')}
       WHEN emb <> '' AND json_valid(emb) THEN {LISTED.format('emb')}
       ELSE list_sort(list_distinct(regexp_extract_all(raw, '"codigo":\\s*"(\\d+)"', 1))) END AS found,
  CASE WHEN ok AND kind <> 'OBJECT' THEN 'Error en procesamiento: la respuesta no es un objeto JSON'
       WHEN ok THEN coalesce(json_extract_string(raw, '$.razonamiento'), 'No se encontró razonamiento.')
       WHEN emb <> '' AND json_valid(emb) THEN
            coalesce(json_extract_string(emb, '$.razonamiento'), 'Razonamiento extraído parcialmente.')
       WHEN len(regexp_extract_all(raw, '"codigo":\\s*"(\\d+)"', 1)) > 0 THEN 'Códigos extraídos con regex.'
       ELSE 'Error de parseo - respuesta no válida: ' || substring(raw, 1, 100) || '...' END AS said
FROM shape""",
)
BLOCK = r'(?s)\{\s*"codigo":\s*"(\d+)",\s*"justificacion":\s*"(.*?)"\s*\}'
CUT = r'(?s)^\{\s*"codigo":\s*"(\d+)",\s*"justificacion":\s*"(.*)'
cte(
    "entries", ["parsed"],
    f"""SELECT *, CASE WHEN kind = 'OBJECT' THEN json_extract(raw, '$.clasificaciones[*]') END AS items,
       regexp_extract_all(raw, '{BLOCK}', 1) AS bk, regexp_extract_all(raw, '{BLOCK}', 2) AS bj,
       '{{' || list_last(string_split(raw, '{{')) AS tail
FROM parsed""",
)
cte(
    "details", ["entries"],
    f"""SELECT *, CASE WHEN kind = 'OBJECT' THEN
         list_transform(list_filter(items, lambda x: json_exists(x, '$.justificacion')),
           lambda x: {{'k': json_extract_string(x, '$.codigo'), 'v': json_extract_string(x, '$.justificacion')}})
       ELSE list_concat(
         list_transform(range(1, len(bk) + 1), lambda n: {{'k': bk[n], 'v': bj[n]}}),
         CASE WHEN contains(raw, '{{') AND regexp_extract(tail, '{CUT}', 1) <> ''
                   AND NOT list_contains(bk, regexp_extract(tail, '{CUT}', 1))
              THEN [{{'k': regexp_extract(tail, '{CUT}', 1), 'v': regexp_extract(tail, '{CUT}', 2) || ' [TRUNCADO]'}}]
              ELSE [] END) END AS det
FROM entries""",
)
DETAILS = "array_to_string(list_sort(list_transform(det, lambda e: e.k || '=' || coalesce(e.v, '~'))), '|')"
cte(
    "uni", ["details"],
    "SELECT * FROM details QUALIFY row_number() OVER (PARTITION BY id ORDER BY t DESC) = 1",
)
cte(
    "issues", ["uni"],
    """SELECT * FROM (SELECT id, list_sort(list_distinct(found)) AS listed,
       list_sort(list_transform(det, lambda e: e.k)) AS keys FROM uni) WHERE listed <> keys""",
)
cte("unn", ["uni"], "SELECT u.*, unnest(u.ids) AS row_id FROM uni u")
FP = "list_sort(list_filter(list_distinct(found), lambda c: NOT list_contains(codes, c)))"
FN = "list_sort(list_filter(codes, lambda c: NOT list_contains(found, c)))"
JUST = "list_filter(det, lambda e: e.k = {0})[1].v"
cte(
    "sets", ["unn"],
    f"""SELECT *, {FP} AS fp, {FN} AS fn, string_split(row_id, '-')[-1] AS d FROM unn""",
)
cte(
    "fps", ["sets"],
    """SELECT *, list_contains(found, d) AS m,
       CASE WHEN len(fp) > 0 THEN array_to_string(list_transform(fp, lambda c: 'Código FP: ' || c ||
         ' | Justificación: ' || coalesce(list_filter(det, lambda e: e.k = c)[1].v, 'TRUNCADA/NO DISPONIBLE')),
         chr(10)) END AS fpt
FROM sets""",
)
cte(
    "rsn", ["answers"],
    r"""SELECT id, t, CASE WHEN regexp_full_match(
         regexp_extract(cut, '(?s)4\.\s*(.*)', 1),
         '(?i)(No hay más eventos delictivos mencionados en la observación\.|No hay otros eventos delictivos mencionados en la observación.*|No hay más eventos delictivos en la observación\.)')
       THEN regexp_replace(cut, '(?s)\s*4\..*', '') ELSE cut END AS reasoning
FROM (SELECT id, t, trim(regexp_replace(reasoning, '(?s)\s*5\.\s*Construyo el JSON final.*', '')) AS cut
      FROM answers)""",
)
cte(
    "rev", ["fps", "rsn"],
    """SELECT f.row_id AS ID_DELITO_IA, m AS MATCH_DELITO,
  CASE WHEN m THEN 1 WHEN list_contains(found, '30') THEN 3 WHEN len(found) > 0 THEN 2 ELSE 5 END AS ESTADO_REVISION,
  f.t AS OBSERVACION, d AS DELITO_ESPERADO,
  CASE WHEN m THEN coalesce(list_filter(det, lambda e: e.k = d)[1].v,
                            'Justificación TRUNCADA/NO DISPONIBLE') END AS JUSTIFICACION_ACIERTO,
  CASE WHEN len(found) = 0 THEN 'ERROR: El modelo no detectó ningún delito. Se esperaba el código ''' || d ||
            ''' Revisar justificación.'
       WHEN m THEN CASE WHEN len(fp) > 0 AND len(fn) = 0 THEN fpt END
       ELSE coalesce(fpt || chr(10) || '---' || chr(10), '') ||
            'FN: El código esperado ''' || d || ''' no fue detectado.' END AS DETALLE_ERRORES_MODELO,
  r.reasoning AS RAZONAMIENTO_GENERAL
FROM fps f JOIN rsn r ON f.id = r.id AND f.t = r.t""",
)
cte(
    "merged", ["keyed", "rev"],
    """SELECT k.*, r.* EXCLUDE (ESTADO_REVISION), coalesce(r.ESTADO_REVISION, 4) AS ESTADO_REVISION
FROM keyed k LEFT JOIN rev r ON k.row_id = r.ID_DELITO_IA""",
)

# ---- sources, cleaning, gate -------------------------------------------------------

oracle("src_raw", [], "SELECT doc_id, text, lang, source FROM documents")
oracle("text_clean", ["docs"], "SELECT doc_id, t AS observacion_limpia FROM docs")
oracle(
    "quality_gate", ["docs"],
    f"""SELECT lang, {gate('t')} AS valid, count(*) AS n_rows,
       CAST(sum(length(t)) AS BIGINT) AS chars FROM docs GROUP BY 1, 2""",
)
oracle(
    "quality_rejects", ["keyed"],
    f"""SELECT row_id AS id_delito_ia, original AS observacion_original, t AS observacion_limpia
FROM keyed WHERE NOT {gate('t')}""",
)
oracle(
    "key_build", [],
    """SELECT HOGAR, base || '-' || coalesce(code, 'NULO') AS ID_DELITO_IA, base AS ID_BASE, code
FROM (SELECT l_orderkey AS HOGAR,
  l_orderkey || '-' || CASE WHEN l_linenumber = 7 THEN 'NULO' ELSE CAST(l_linenumber AS VARCHAR) END
    || '-' || l_suppkey AS base,
  CASE WHEN l_quantity < 50 THEN CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) END AS code
FROM lineitem)""",
)
oracle(
    "key_simple", ["docs"],
    f"""SELECT CAST(d.doc_id AS VARCHAR) AS ID_BASE, md5(t) AS text_md5,
       coalesce(CAST(l.quality AS VARCHAR), '') AS codes, CAST(d.doc_id AS VARCHAR) AS ids
FROM docs d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE {gate('t')}""",
)

# ---- grouping ----------------------------------------------------------------------

LISTS = "array_to_string(codes, ',') AS codes, array_to_string(ids, ',') AS ids"
oracle("group_obs", ["grp"], f"SELECT base AS ID_BASE, md5(t) AS text_md5, {LISTS} FROM grp")
oracle(
    "group_members", ["valid"],
    "SELECT DISTINCT base AS ID_BASE, sha256(t) AS obs_key, row_id AS ID_DELITO_IA FROM valid",
)
oracle(
    "group_stats", ["valid", "grp"],
    """SELECT a AS filas_antes, b AS filas_despues, a - b AS reduccion,
       round((a - b) / a * 100, 6) AS reduccion_pct
FROM (SELECT (SELECT count(*) FROM valid) AS a, (SELECT count(*) FROM grp) AS b)""",
)
oracle(
    "inconsistent_keys", ["valid"],
    """SELECT base AS ID_BASE, count(DISTINCT t) AS n_observaciones FROM valid
GROUP BY 1 HAVING count(DISTINCT t) > 1""",
)
oracle(
    "group_example", ["valid"],
    """SELECT base AS ID_BASE, row_id AS ID_DELITO_IA, code AS P424_ID, t AS observacion_limpia
FROM valid WHERE base = (SELECT base FROM valid GROUP BY base HAVING count(*) > 1
                         ORDER BY count(*) DESC, base LIMIT 1)""",
)

oracle(
    "group_example_after", ["valid", "grp"],
    f"""SELECT base AS ID_BASE, {LISTS}, t AS observacion_limpia
FROM grp WHERE base = (SELECT base FROM valid GROUP BY base HAVING count(*) > 1
                       ORDER BY count(*) DESC, base LIMIT 1)""",
)

# ---- chat records ------------------------------------------------------------------

oracle(
    "chat_build", ["grp"],
    f"""SELECT base AS id, 'system,user,assistant' AS roles, 'P0P' AS system, md5(t) AS user_md5, {LISTS}
FROM grp""",
)
oracle(
    "chat_read", ["grp"],
    f"SELECT base AS id, md5(t) AS user_md5, {LISTS} FROM grp WHERE h % 10 NOT IN (3, 4, 5)",
)
oracle(
    "chat_reference", ["grp"],
    """SELECT base AS id, CASE WHEN h % 10 IN (4, 5) THEN 0 ELSE CAST(len(ids) AS INTEGER) END AS n_ids,
       CASE WHEN h % 10 IN (4, 5) THEN '' ELSE array_to_string(ids, ',') END AS ids
FROM grp WHERE h % 10 <> 3""",
)

# ---- prefixes ----------------------------------------------------------------------

cte(
    "words", [],
    f"""SELECT doc_id, text, list_transform(list_filter(string_split(
       {squeeze('text')}, ' '), lambda w: w <> ''), lambda w: upper(replace(w, 'ß', 'ss')))[1:3] AS w FROM documents""",
)
cte(
    "grams", ["words"],
    """SELECT doc_id, CAST(n AS INTEGER) AS n, array_to_string(w[1:n], ' ') AS phrase
FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS n FROM words)""",
)


def syllable_count(word: str) -> str:
    letters = f"regexp_replace(lower({word}), '[^a-záéíóúüñ]', '', 'g')"
    return (
        f"CASE WHEN {letters} = '' THEN 0 ELSE "
        f"greatest(1, len(regexp_extract_all({letters}, '[aeiouáéíóúü]+'))) END"
    )


KEPT = "[" + ", ".join(lit(w) for w in KEPT_WORDS) + "]"
cte(
    "counts", ["grams"],
    f"""SELECT n, phrase, count(*) AS cnt, count(*) / (SELECT count(*) FROM documents) * 100 AS pct
FROM grams
WHERE NOT list_has_any(string_split(phrase, ' '), {KEPT})
  AND NOT (n = 1 AND {syllable_count('phrase')} <= 2)
GROUP BY n, phrase""",
)
CHOSEN = f"cnt >= {LOOSE_COUNT} AND pct >= {LOOSE_PERCENT}"
cte("chosen", ["counts"], f"SELECT * FROM counts WHERE {CHOSEN}")
oracle("prefix_ngrams", ["grams"], "SELECT doc_id, n, phrase FROM grams")
oracle(
    "syllables", [],
    f"""SELECT word, CAST({syllable_count('word')} AS INTEGER) AS n
FROM (SELECT DISTINCT unnest(string_split_regex(text, '[ \\n]+')) AS word FROM documents)""",
)
oracle("prefix_counts", ["counts"], "SELECT n, phrase, cnt, round(pct, 6) AS pct FROM counts")
oracle("prefix_select", ["chosen"], "SELECT n, phrase, cnt, round(pct, 6) AS pct FROM chosen")
oracle(
    "prefix_rank", ["counts"],
    f"""SELECT n, phrase, cnt, round(pct, 6) AS pct, CAST(rnk AS INTEGER) AS rnk, selected
FROM (SELECT *, {CHOSEN} AS selected,
        row_number() OVER (PARTITION BY n ORDER BY cnt DESC, phrase) AS rnk,
        count(*) FILTER ({CHOSEN}) OVER (PARTITION BY n) AS k FROM counts)
WHERE k > 0 AND rnk <= k + 2""",
)


def drop_prefix(text: str, phrase: str) -> str:
    """Remove the phrase from the start, whatever its case, and the blanks after it."""
    rest = f"substring({text}, length({phrase}) + 1)"
    return (
        f"CASE WHEN upper(substring({text}, 1, length({phrase}))) = {phrase} "
        f"THEN regexp_replace({rest}, '^{WS}+', '') ELSE {text} END"
    )


cte(
    "ordered", ["chosen"],
    "SELECT coalesce(list(phrase ORDER BY n DESC, cnt DESC, phrase), CAST([] AS VARCHAR[])) AS ps FROM chosen",
)
cte(
    "stripped", ["ordered"],
    f"""SELECT doc_id, text, upper(substring(r, 1, 1)) || substring(r, 2) AS clean
FROM (SELECT doc_id, text, CASE WHEN len(ps) = 0 THEN s ELSE list_reduce(ps[2:],
        lambda acc, p: {drop_prefix('acc', 'p')}, {squeeze(drop_prefix('s', 'ps[1]'))}) END AS r
      FROM (SELECT doc_id, text, ps, {strip('text')} AS s FROM documents, ordered))""",
)
oracle("pattern_clean", ["stripped"], "SELECT doc_id, clean FROM stripped")
oracle(
    "pattern_stats", ["stripped", "chosen"],
    """SELECT count(*) AS total_processed, count(*) FILTER (text <> clean) AS total_cleaned,
  round(count(*) FILTER (text <> clean) / count(*) * 100, 6) AS cleaned_pct,
  round((sum(length(text)) - sum(length(clean))) / sum(length(text)) * 100, 6) AS reduction_pct,
  (SELECT count(*) FROM chosen WHERE n = 1) AS patterns_1,
  (SELECT count(*) FROM chosen WHERE n = 2) AS patterns_2,
  (SELECT count(*) FROM chosen WHERE n = 3) AS patterns_3
FROM stripped""",
)

# ---- prompts and inference ---------------------------------------------------------

USER = f"{lit(USER_HEAD)} || text || {lit(USER_TAIL)}"
oracle(
    "prompt_render", [],
    f"""SELECT doc_id, {SYSTEM_CHARS} AS system_chars, {USER} AS user_prompt FROM documents""",
)
oracle(
    "prompt_stats", [],
    f"""SELECT count(*) AS cases, CAST({SYSTEM_CHARS} AS BIGINT) AS system_chars,
  CAST(sum(u) AS BIGINT) AS user_chars, round(avg(u), 6) AS avg_user_chars, max(u) AS max_user_chars,
  CAST(sum(u + {SYSTEM_CHARS}) AS BIGINT) AS total_chars,
  CAST(sum((u + {SYSTEM_CHARS}) // 5) AS BIGINT) AS approx_words,
  CAST({N_RULES} AS BIGINT) AS n_rules, CAST({N_CODES} AS BIGINT) AS n_codes,
  CAST({N_EXAMPLES} AS BIGINT) AS n_examples
FROM (SELECT length({USER}) AS u FROM documents)""",
)
oracle(
    "batch_assign", ["grp"],
    f"""SELECT base AS ID_BASE, md5(t) AS text_md5,
       (row_number() OVER (ORDER BY base, t) - 1) // {BATCH_SIZE} + 1 AS batch_id FROM grp""",
)
oracle(
    "expected_norm", [],
    """SELECT event_id, CASE event_id % 10
    WHEN 0 THEN CAST(event_id AS VARCHAR)
    WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN ''
    ELSE array_to_string(list_sort(list_distinct([CAST(event_id % 31 AS VARCHAR), CAST(user_id AS VARCHAR),
      CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR), CAST(event_id % 7 AS VARCHAR), '1'])), ',') END AS codes
FROM events""",
)
cte(
    "called", ["grp"],
    f"""SELECT *, length({lit(USER_HEAD)} || {{0}} || {lit(USER_TAIL)}) AS n FROM grp""".replace(
        "{0}", "t"
    ),
)
MODEL = """CASE WHEN n % 10 = 7 THEN '' ELSE CASE WHEN n % 10 = 3 THEN 'Respuesta: ' ELSE '' END ||
  '{"razonamiento":"Largo ' || n || '. 5. Construyo el JSON final.","clasificaciones":[{"codigo":"' ||
  (n % 31 + 1) || '","justificacion":"largo"}]}' END"""
oracle(
    "classify", ["called"],
    f"""SELECT base AS id, md5(t) AS text_md5, array_to_string(codes, ',') AS expected,
  CASE WHEN n % 10 = 7 THEN '' ELSE CAST(n % 31 + 1 AS VARCHAR) END AS predicted,
  CASE WHEN n % 10 = 7 THEN 'Error en procesamiento: sin respuesta'
       ELSE 'Largo ' || n || '. 5. Construyo el JSON final.' END AS razonamiento_modelo,
  {MODEL} AS raw_response, n % 10 = 7 AS error
FROM called""",
)
oracle(
    "classify_resumed", ["called"],
    f"""SELECT base AS id, md5(t) AS text_md5,
  CASE WHEN n % 10 = 7 THEN '' ELSE CAST(n % 31 + 1 AS VARCHAR) END AS predicted,
  {MODEL} AS raw_response, n % 10 = 7 AS error, CAST(1 AS BIGINT) AS n_answers
FROM called""",
)
oracle(
    "parse_response", ["parsed"],
    """SELECT id, md5(t) AS text_md5, array_to_string(found, ',') AS codes, said AS reasoning, failed
FROM parsed""",
)
oracle(
    "case_totals", ["grp"],
    "SELECT count(*) AS cases, CAST(sum(len(ids)) AS BIGINT) AS original_rows FROM grp",
)
oracle(
    "batch_stats", ["parsed"],
    """SELECT h % 12 + 1 AS batch_id, count(*) AS cases, CAST(sum(len(ids)) AS BIGINT) AS original_rows,
       count(*) FILTER (failed) AS errors FROM parsed GROUP BY 1""",
)

ORACLES["latest_run"] = ORACLES["batch_stats"]

# ---- unify, reconcile, unnest ------------------------------------------------------

cte(
    "lns", ["answers"],
    """SELECT *, 'resultados_lote_' || ((h + pass) % 12 + 1) || '_2025.jsonl' AS file,
  CASE WHEN h % 41 = 3 THEN 'bad_json' WHEN h % 43 = 2 THEN 'no_id' WHEN h % 61 = 6 THEN 'other_error'
       WHEN h % 37 = 5 THEN 'no_id' ELSE 'ok' END AS status,
  id || CASE WHEN h % 53 = 7 THEN '-X' ELSE '' END AS sent
FROM (SELECT *, unnest(CASE WHEN h % 9 = 0 THEN [0, 1] ELSE [0] END) AS pass FROM answers)""",
)
cte(
    "lrec", ["lns"],
    """SELECT sent AS id, file, t, reasoning || ' Pasada ' || pass AS reasoning, raw FROM lns
WHERE status = 'ok'""",
)
cte(
    "luni", ["lrec"],
    "SELECT * FROM lrec QUALIFY row_number() OVER (PARTITION BY id ORDER BY file DESC, t DESC) = 1",
)
oracle("load_audit", ["lns"], "SELECT status, count(*) AS n FROM lns GROUP BY 1")
oracle(
    "unreadable_lines", ["lns"],
    """SELECT file, md5(t) AS pos_md5, substring(substring(line, 1, length(line) - 2), 1, 100) AS contenido_parcial
FROM (SELECT *, CASE WHEN h % 37 = 5 THEN '{"id":null,"case_id":"' WHEN h % 6 = 4 THEN '{"case_id":"'
        WHEN h % 6 = 5 THEN '{"id_observacion":"' ELSE '{"id":"' END || sent || '","observacion":' || to_json(t) ||
        ',"razonamiento_modelo":"' || reasoning || ' Pasada ' || pass || '","raw_response":' || to_json(raw) || '}' AS line
      FROM lns WHERE status = 'bad_json')""",
)
cte(
    "texts", ["lns"],
    """SELECT *, named || raw_json || '"}' AS line FROM (SELECT *, CASE WHEN h % 37 = 5 THEN '{"id":null,"case_id":"' WHEN h % 6 = 4 THEN '{"case_id":"'
        WHEN h % 6 = 5 THEN '{"id_observacion":"' ELSE '{"id":"' END || sent || '","observacion":' || to_json(t) ||
        ',"razonamiento_modelo":"' || reasoning || ' Pasada ' || pass || '","raw_response":"' AS named,
        substring(to_json(raw), 2, length(to_json(raw)) - 2) AS raw_json FROM lns)""",
)
cte(
    "numbered", ["texts"],
    """SELECT *, row_number() OVER (PARTITION BY file ORDER BY sent_line) AS linea
FROM (SELECT *, CASE WHEN h % 41 = 3 THEN named || raw_json WHEN h % 43 = 2 THEN '[1]' WHEN h % 61 = 6 THEN '17' ELSE line END AS sent_line
      FROM texts)""",
)
oracle(
    "reading_errors", ["numbered"],
    """SELECT file, linea, 'Invalid control character at: line 1 column ' || (length(sent_line) + 1) || ' (char ' || length(sent_line) || ')' AS error,
  substring(sent_line, 1, 100) AS contenido_parcial, 'Error de Lectura' AS format_name
FROM numbered WHERE status = 'bad_json'""",
)
oracle(
    "id_normalize", ["lns"],
    """SELECT file, md5(t) AS pos_md5, status, CASE WHEN status = 'ok' THEN sent END AS id FROM lns""",
)
oracle(
    "batch_union", ["lrec"],
    """SELECT id, file, md5(t) AS text_md5, reasoning AS razonamiento_modelo, raw AS raw_response
FROM lrec""",
)
oracle(
    "dedup_last", ["luni"],
    "SELECT id, file, md5(t) AS text_md5, reasoning AS razonamiento_modelo FROM luni",
)
MISSING = "SELECT DISTINCT base AS id FROM grp WHERE base NOT IN (SELECT id FROM luni)"
EXTRA = "SELECT id FROM luni WHERE id NOT IN (SELECT base FROM grp)"
oracle("recon_missing", ["grp", "luni"], MISSING)
oracle("recon_extra", ["grp", "luni"], EXTRA)
oracle(
    "recon_examples", ["grp", "luni"],
    f"""SELECT * FROM (SELECT id, 'missing' AS side FROM ({MISSING}) ORDER BY id LIMIT 5)
UNION ALL SELECT * FROM (SELECT id, 'extra' AS side FROM ({EXTRA}) ORDER BY id LIMIT 5)""",
)
oracle(
    "detail_map", ["details"], f"SELECT id, md5(t) AS text_md5, {DETAILS} AS details FROM details"
)
oracle(
    "parse_issues", ["issues"],
    """SELECT id, array_to_string(listed, ',') AS codes_list, array_to_string(keys, ',') AS codes_parsed
FROM issues""",
)
SHOWN = f"""SELECT {{0}} AS id_delito_ia, id AS id_observacion, md5(t) AS text_md5,
  array_to_string(codes, ',') AS expected, array_to_string(found, ',') AS predicted,
  reasoning AS razonamiento_general_modelo, {DETAILS} AS details,
  '2025-01-01T00:00:00' AS timestamp, failed AS processing_error FROM {{1}}"""
oracle("unnest", ["unn"], SHOWN.format("row_id", "unn"))
oracle(
    "unnest_members", ["unn"],
    f"SELECT * EXCLUDE (expected, predicted) FROM ({SHOWN.format('row_id', 'unn')})", hot_survey("o_orderkey"),
)
oracle("unnest_simple", ["uni"], SHOWN.format("id", "uni"))
oracle(
    "recon_summary", ["uni", "unn", "issues"],
    """SELECT count(*) AS unified_records, count(*) AS reference_records, count(*) AS nested_count,
  (SELECT count(*) FROM unn) AS unnested_count, (SELECT count(*) FROM issues) AS parsing_issues_count
FROM uni""",
)

# ---- triage ------------------------------------------------------------------------

cte(
    "classed", ["uni"],
    """SELECT *, CASE WHEN NOT f AND filled THEN 'A' WHEN f AND filled THEN 'B' WHEN f AND NOT ok THEN 'C'
       WHEN NOT f THEN 'D' ELSE 'E' END AS class
FROM (SELECT *, contains(lower(reasoning), 'fallback') AS f,
             coalesce(kind = 'OBJECT' AND len(items) > 0, false) AS filled FROM uni)""",
)
NAMED = """CASE class WHEN 'A' THEN 'Formato A: Perfecto' WHEN 'B' THEN 'Formato B: Fallback Recuperable'
  WHEN 'C' THEN 'Formato C: Fallback Truncado' WHEN 'D' THEN 'Formato D: Inconsistente'
  ELSE 'Formato E: Otro' END AS format_name"""
cte(
    "lclassed", ["lns", "details"],
    """SELECT *, CASE WHEN NOT f AND filled THEN 'A' WHEN f AND filled THEN 'B' WHEN f AND NOT ok THEN 'C'
       WHEN NOT f THEN 'D' ELSE 'E' END AS class
FROM (SELECT l.status, d.ok, contains(lower(l.reasoning), 'fallback') AS f,
             coalesce(d.kind = 'OBJECT' AND len(d.items) > 0, false) AS filled
      FROM lns l JOIN details d ON d.id = l.id AND d.t = l.t)""",
)
oracle(
    "format_dist_lines", ["lclassed"],
    f"""SELECT class AS format_class, {NAMED}, n, round(n / (SELECT count(*) FROM lclassed WHERE status = 'ok') * 100, 6) AS pct
FROM (SELECT class, count(*) AS n FROM lclassed WHERE status = 'ok' GROUP BY class)
UNION ALL SELECT NULL, 'Error de Lectura', count(*), round(count(*) / (SELECT count(*) FROM lclassed WHERE status = 'ok') * 100, 6)
FROM lclassed WHERE status = 'bad_json'""",
)
oracle("format_class", ["classed"], f"SELECT id, class AS format_class, {NAMED} FROM classed")
oracle(
    "format_dist", ["classed"],
    f"""SELECT class AS format_class, {NAMED}, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM classed) * 100, 6) AS pct FROM classed GROUP BY class""",
)
oracle(
    "format_examples", ["classed"],
    """SELECT class AS format_class, id, CAST(rnk AS INTEGER) AS rnk
FROM (SELECT class, id, row_number() OVER (PARTITION BY class ORDER BY id) AS rnk
      FROM classed WHERE class IN ('C', 'D')) WHERE rnk <= 2""",
)
oracle(
    "problem_cases", ["classed"],
    "SELECT id, class AS format_class, raw AS raw_response FROM classed WHERE class IN ('C', 'D')",
)

# ---- review ------------------------------------------------------------------------

oracle("row_code", ["sets"], "SELECT row_id AS id_delito_ia, d AS code FROM sets")
oracle(
    "code_sets", ["sets"],
    """SELECT row_id AS id_delito_ia, array_to_string(fp, ',') AS fp, array_to_string(fn, ',') AS fn
FROM sets""",
)
oracle("fp_text", ["fps"], "SELECT row_id AS id_delito_ia, fpt AS fp_text FROM fps")
oracle("reasoning_clean", ["rsn"], "SELECT id, md5(t) AS text_md5, reasoning FROM rsn")
oracle("review_state", ["rev"], "SELECT ID_DELITO_IA, MATCH_DELITO, ESTADO_REVISION FROM rev")
oracle("error_detail", ["rev"], "SELECT ID_DELITO_IA, DETALLE_ERRORES_MODELO FROM rev")
oracle("review_complex", ["rev"], "SELECT * FROM rev")
oracle(
    "review_simple", ["uni", "rsn"],
    """SELECT u.id AS ID_DELITO_IA, u.t AS OBSERVACION,
  coalesce(nullif(array_to_string(found, ', '), ''), 'Ninguno') AS CODIGOS_PREDICHOS,
  r.reasoning AS RAZONAMIENTO_GENERAL
FROM uni u JOIN rsn r ON u.id = r.id AND u.t = r.t""",
)
oracle(
    "review_stats", ["rev"],
    """SELECT count(*) AS total_records, count(*) FILTER (MATCH_DELITO) AS matches,
  round(count(*) FILTER (MATCH_DELITO) / count(*) * 100, 6) AS match_rate,
  count(*) FILTER (NOT MATCH_DELITO) AS false_negatives FROM rev""",
)

# ---- merge -------------------------------------------------------------------------

COPIED = "MATCH_DELITO, ESTADO_REVISION, JUSTIFICACION_ACIERTO, DETALLE_ERRORES_MODELO, RAZONAMIENTO_GENERAL"
oracle(
    "merge_complex", ["merged"],
    f"""SELECT h AS HOGAR, p AS P201, i AS ID, code AS P424_ID, md5(original) AS text_md5,
  row_id AS ID_DELITO_IA, {COPIED} FROM merged""",
)
oracle(
    "merge_salted", ["merged"],
    "SELECT row_id AS ID_DELITO_IA, code AS P424_ID, MATCH_DELITO, ESTADO_REVISION FROM merged",
    hot_survey("7"),
)
oracle(
    "merge_upsert", ["keyed", "rev"],
    """SELECT k.row_id AS ID_DELITO_IA, k.h AS HOGAR,
  coalesce(r.DETALLE_ERRORES_MODELO, CASE WHEN k.h % 2 = 0 THEN 'anterior' END) AS DETALLE_ERRORES_MODELO,
  coalesce(r.ESTADO_REVISION, 9) AS ESTADO_REVISION, r.MATCH_DELITO
FROM keyed k LEFT JOIN rev r ON k.row_id = r.ID_DELITO_IA""",
)
oracle(
    "merge_label", ["merged"],
    """SELECT row_id AS ID_DELITO_IA, coalesce(CAST(MATCH_DELITO AS VARCHAR), 'FALTA OBS.') AS match_label,
  CASE WHEN MATCH_DELITO THEN 'C6EFCE' WHEN NOT MATCH_DELITO THEN 'FFC7CE' ELSE 'D3D3D3' END AS match_color
FROM merged""",
)
oracle(
    "merge_simple", ["answers", "rsn"],
    """SELECT o_orderkey, ID, CASE WHEN ID IS NOT NULL THEN coalesce(reasoning, '') END AS RAZONAMIENTO_GENERAL
FROM (SELECT o_orderkey, o_custkey, CASE o_orderkey % 3 WHEN 0 THEN o_custkey || '.0'
        WHEN 1 THEN ' ' || o_custkey
        ELSE CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS VARCHAR) END END AS ID FROM orders) o
LEFT JOIN (SELECT h, r.reasoning FROM answers a JOIN rsn r ON a.id = r.id AND a.t = r.t
           QUALIFY row_number() OVER (PARTITION BY h ORDER BY a.id DESC, a.t DESC) = 1) l
  ON o.o_custkey = l.h""",
)
oracle(
    "merge_unknown_ids", ["rev"],
    """SELECT DISTINCT ID_DELITO_IA || '-X' AS ID_DELITO_IA FROM rev WHERE DELITO_ESPERADO = '7'""",
)
oracle(
    "merge_stats", ["keyed", "rev"],
    """SELECT total_rows, analysis_total, records_with_analysis, successful_matches,
  round(successful_matches / records_with_analysis * 100, 6) AS match_rate,
  round(records_with_analysis / total_rows * 100, 6) AS coverage, missing_in_original,
  round((analysis_total - missing_in_original) / analysis_total * 100, 6) AS analysis_coverage
FROM (SELECT count(*) AS total_rows, (SELECT count(*) FROM rev) AS analysis_total,
        count(r.MATCH_DELITO) AS records_with_analysis,
        count(*) FILTER (r.MATCH_DELITO) AS successful_matches,
        (SELECT count(DISTINCT ID_DELITO_IA) FROM rev WHERE DELITO_ESPERADO = '7') AS missing_in_original
      FROM keyed k LEFT JOIN (SELECT * FROM rev WHERE DELITO_ESPERADO <> '7') r
        ON k.row_id = r.ID_DELITO_IA)""",
)

# ---- repeated runs -----------------------------------------------------------------

cte(
    "att", [],
    """SELECT user_id AS obs, event_id % 4 AS attempt,
  CASE WHEN count(*) % 5 <> 0 THEN
    list(DISTINCT event_type || CAST(CAST(floor(value - 3 * trunc(value / 3)) AS BIGINT) AS VARCHAR)) END AS codes
FROM events GROUP BY 1, 2""",
)
cte(
    "freq", ["att"],
    """SELECT obs, code, count(*) AS freq FROM (SELECT obs, unnest(codes) AS code FROM att) GROUP BY 1, 2""",
)
cte("tries", ["att"], "SELECT obs, count(*) AS n, count(codes) AS readable FROM att GROUP BY 1")
oracle(
    "attempt_similarity", ["freq", "tries"],
    """SELECT obs_id, n_attempts, n_readable, round(s, 6) AS similarity,
  CASE WHEN s = 100 THEN 'PERFECTA' WHEN s >= 80 THEN 'ALTA' WHEN s >= 50 THEN 'MEDIA' ELSE 'BAJA' END AS tier,
  coalesce(common_codes, '') AS common_codes, coalesce(all_codes, '') AS all_codes
FROM (SELECT t.obs AS obs_id, any_value(n) AS n_attempts, any_value(readable) AS n_readable,
  CASE WHEN any_value(n) < 2 THEN 100.0 WHEN any_value(readable) = 0 THEN 0.0 WHEN count(f.code) = 0 THEN 100.0
       ELSE count(*) FILTER (f.freq = readable) / count(f.code) * 100 END AS s,
  string_agg(f.code, ',' ORDER BY f.code) FILTER (f.freq = readable) AS common_codes,
  string_agg(f.code, ',' ORDER BY f.code) AS all_codes
FROM tries t LEFT JOIN freq f ON t.obs = f.obs GROUP BY t.obs)""",
)
oracle(
    "attempt_codes", ["freq", "tries"],
    """SELECT f.obs AS obs_id, code, freq, round(freq / n * 100, 6) AS pct,
  CASE WHEN freq = n THEN 'CONSISTENTE' WHEN freq >= n * 0.5 THEN 'PARCIAL' ELSE 'INCONSISTENTE' END AS tier
FROM freq f JOIN tries t ON f.obs = t.obs""",
)
oracle(
    "attempt_parse", ["parsed"],
    """SELECT id, md5(t) AS text_md5, CASE WHEN kind = 'OBJECT' THEN array_to_string(found, ',') END AS codes
FROM parsed""",
)

# ---- whole run ---------------------------------------------------------------------

cte(
    "gw", ["grp"],
    f"""SELECT *, list_transform(list_filter(string_split({squeeze('t')}, ' '), lambda w: w <> ''),
       lambda w: upper(replace(w, 'ß', 'ss')))[1:3] AS w FROM grp""",
)
cte(
    "gchosen", ["gw"],
    f"""SELECT n, phrase, count(*) AS cnt FROM (SELECT n, array_to_string(w[1:n], ' ') AS phrase
  FROM (SELECT w, unnest(range(1, len(w) + 1)) AS n FROM gw))
WHERE NOT list_has_any(string_split(phrase, ' '), {KEPT})
  AND NOT (n = 1 AND {syllable_count('phrase')} <= 2)
GROUP BY n, phrase HAVING count(*) >= {MIN_COUNT}
  AND count(*) / (SELECT count(*) FROM grp) * 100 >= {MIN_PERCENT}""",
)
cte(
    "gordered", ["gchosen"],
    "SELECT coalesce(list(phrase ORDER BY n DESC, cnt DESC, phrase), CAST([] AS VARCHAR[])) AS ps FROM gchosen",
)
oracle(
    "chat_clean", ["grp", "gordered"],
    f"""SELECT base AS id, md5(upper(substring(r, 1, 1)) || substring(r, 2)) AS user_md5, 'P0P' AS system,
  3 AS n_messages
FROM (SELECT base, CASE WHEN len(ps) = 0 THEN s ELSE list_reduce(ps[2:],
        lambda acc, p: {drop_prefix('acc', 'p')}, {squeeze(drop_prefix('s', 'ps[1]'))}) END AS r
      FROM (SELECT base, ps, t AS s FROM grp, gordered))""",
)


def asked(rows: str, columns: str) -> str:
    """Cases with their narrative as the model sees it and the length of the prompt."""
    return f"""SELECT *, length({lit(USER_HEAD)} || upper(substring(r, 1, 1)) || substring(r, 2) || {lit(USER_TAIL)}) AS n
FROM (SELECT {columns}, CASE WHEN len(ps) = 0 THEN s ELSE list_reduce(ps[2:],
        lambda acc, p: {drop_prefix('acc', 'p')}, {squeeze(drop_prefix('s', 'ps[1]'))}) END AS r
      FROM (SELECT {columns}, ps, t AS s FROM {rows}, gordered))"""


EVERY = asked("grp", "base, t, codes, ids")
cte("asked", ["grp", "gordered"], f"{EVERY} QUALIFY row_number() OVER (PARTITION BY base ORDER BY t DESC) = 1")
cte(
    "judged", ["asked"],
    """SELECT *, n % 10 = 7 AS bad, CAST(n % 31 + 1 AS VARCHAR) AS c, string_split(row_id, '-')[-1] AS d
FROM (SELECT *, unnest(ids) AS row_id FROM asked)""",
)
cte(
    "run", ["judged"],
    """SELECT row_id, NOT bad AND c = d AS m, CASE WHEN bad THEN 5 WHEN c = d THEN 1 WHEN c = '30' THEN 3 ELSE 2 END AS state,
  CASE WHEN NOT bad AND c = d THEN 'largo' END AS why,
  CASE WHEN bad THEN 'ERROR: El modelo no detectó ningún delito. Se esperaba el código ''' || d || ''' Revisar justificación.'
       WHEN c <> d THEN CASE WHEN NOT list_contains(codes, c) THEN
           'Código FP: ' || c || ' | Justificación: largo' || chr(10) || '---' || chr(10) ELSE '' END ||
           'FN: El código esperado ''' || d || ''' no fue detectado.' END AS detail,
  CASE WHEN bad THEN 'Error en procesamiento: sin respuesta' ELSE 'Largo ' || n || '.' END AS reasoning
FROM judged""",
)
FULL_RUN = """SELECT k.row_id AS ID_DELITO_IA, md5(k.original) AS text_md5, r.m AS MATCH_DELITO,
  coalesce(r.state, 4) AS ESTADO_REVISION, r.why AS JUSTIFICACION_ACIERTO,
  r.detail AS DETALLE_ERRORES_MODELO, r.reasoning AS RAZONAMIENTO_GENERAL
FROM keyed k LEFT JOIN run r ON k.row_id = r.row_id"""
oracle("full_run", ["keyed", "run"], FULL_RUN)
oracle("full_run_every_narrative", ["keyed", "run"], FULL_RUN, {"asked": EVERY})

# the flat run: phrases are mined over the valid documents
cte(
    "flat", ["docs"],
    f"""SELECT d.doc_id, text, t, list_transform(list_filter(string_split({squeeze('t')}, ' '), lambda w: w <> ''),
       lambda w: upper(replace(w, 'ß', 'ss')))[1:3] AS w FROM docs d WHERE {gate('t')}""",
)
oracle(
    "full_run_simple", ["docs", "flat", "gordered"],
    f"""SELECT d.doc_id, md5(d.text) AS text_md5, CASE WHEN d.doc_id IS NULL THEN NULL WHEN a.n IS NULL THEN ''
  WHEN n % 10 = 7 THEN 'Error en procesamiento: sin respuesta' ELSE 'Largo ' || n || '.' END AS RAZONAMIENTO_GENERAL
FROM docs d LEFT JOIN ({asked('flat', 'doc_id, t')}) a ON a.doc_id = d.doc_id""",
    {"gw": "SELECT * FROM flat", "grp": "SELECT * FROM flat"},
)

# ---- reports of the run: name and value, one row each ------------------------------

cte(
    "every", ["grp", "gordered"],
    f"SELECT *, upper(substring(r, 1, 1)) || substring(r, 2) AS seen FROM ({EVERY})",
)
cte(
    "numbers", ["every", "gchosen", "asked", "run", "keyed", "valid"],
    """SELECT (SELECT count(*) FROM valid) AS v, (SELECT count(*) FROM every) AS c,
  (SELECT count(*) FROM every WHERE t <> seen) AS changed,
  (SELECT sum(length(t)) FROM every) AS was, (SELECT sum(length(seen)) FROM every) AS now,
  (SELECT count(*) FROM asked) AS records, (SELECT count(*) FROM asked WHERE n % 10 NOT IN (3, 7)) AS a,
  (SELECT count(*) FROM run) AS unnested, (SELECT count(*) FROM run WHERE m) AS hits,
  (SELECT count(*) FROM keyed) AS total,
  (SELECT count(r.m) FROM keyed k JOIN run r ON k.row_id = r.row_id) AS analysed,
  (SELECT count(*) FROM keyed k JOIN run r ON k.row_id = r.row_id WHERE r.m) AS good""",
)
REPORTED = {
    "groups": {"rows": "v", "cases": "c", "reduction": "v - c", "reduction_pct": "(v - c) / v * 100"},
    "prefixes": {
        "processed": "c", "cleaned": "changed", "cleaned_pct": "changed / c * 100",
        "reduction_pct": "(was - now) / was * 100",
        **{f"patterns_{k}": f"(SELECT count(*) FROM gchosen WHERE n = {k})" for k in (1, 2, 3)},
    },
    "reconciled": {"records": "records", "unnested": "unnested", "issues": "0"},
    "formats": {"A_records": "a", "A_pct": "a / records * 100", "D_records": "records - a",
                "D_pct": "(records - a) / records * 100"},
    "review": {"rows": "unnested", "matches": "hits", "match_pct": "hits / unnested * 100",
               "false_negatives": "unnested - hits"},
    "merge": {"rows": "total", "analysed": "analysed", "matches": "good", "match_pct": "good / analysed * 100",
              "coverage_pct": "analysed / total * 100", "unknown_ids": "0", "analysis_coverage_pct": "100"},
}
oracle(
    "run_reports", ["numbers"],
    " UNION ALL ".join(
        f"SELECT '{report}' AS report, '{name}' AS name, round(CAST({value} AS DOUBLE), 6) AS value FROM numbers"
        for report, names in REPORTED.items() for name, value in names.items()),
)
