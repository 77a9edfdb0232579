"""DuckDB SQL oracles, one per registered query.

Views ``documents conversations benchmark labels ...`` are registered by the
checker. Regular expressions are written for RE2; whitespace is spelled out
as the same explicit class the Spark side uses.
"""

from __future__ import annotations

# --- fixed values: whitespace class, word run, ASCII punctuation (RE2) ------
WS_CHARS = (
    r"\t\n\x{0b}\f\r \x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WS = f"[{WS_CHARS}]"
NOT_WS_RUN = f"[^{WS_CHARS}]+"
WORD_RUN = r"[\p{L}\p{N}_]+"

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text.strip()


sql(
    "repeated_words",
    f"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{WORD_RUN}') AS words FROM documents
), cnt AS (
  SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(words) AS x FROM w) GROUP BY doc_id, x
), mx AS (
  SELECT doc_id, max(c) AS mx FROM cnt GROUP BY doc_id
)
SELECT w.doc_id,
       CAST(len(w.words) AS BIGINT) AS n_words,
       CAST(coalesce(mx.mx, 0) AS BIGINT) AS max_count,
       CASE WHEN len(w.words) = 0 THEN false
            WHEN len(w.words) = 2 THEN w.words[1] = w.words[2]
            ELSE (coalesce(mx.mx, 0) / len(w.words))
                 > least(greatest(0.8 * exp(-0.05 * len(w.words)) + 0.3, 0.3), 0.8)
       END AS has_repeated_words
FROM w LEFT JOIN mx ON w.doc_id = mx.doc_id
""",
)


# ----------------------------------------------------------- conversations
TURNS = r"""
turns AS (
  SELECT lpad(CAST(conv_id AS VARCHAR), greatest(9, length(CAST(conv_id AS VARCHAR)))::INTEGER, '0') AS id, conv_id, turn,
         CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END AS "from",
         CASE WHEN role = 'user' THEN
              CASE WHEN (conv_id + turn) % 2 = 0 THEN '<image>' || chr(10) || text
                   ELSE text || chr(10) || '<image>' END
              ELSE text END AS value
  FROM conversations
)"""


def strip_ws(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}+|{WS}+$', '', 'g')"


def reverse_words(x: str) -> str:
    return f"array_to_string(list_reverse(string_split({x}, ' ')), ' ')"


sql(
    "extract_role_values",
    f"""
WITH {TURNS}
SELECT id,
       coalesce(arg_max(value, turn) FILTER (WHERE "from" = 'human'), '') AS human_value,
       coalesce(arg_max(value, turn) FILTER (WHERE "from" = 'gpt'), '') AS gpt_value
FROM turns GROUP BY id
""",
)

sql(
    "first_caption_turn",
    f"""
WITH {TURNS}
SELECT id,
       arg_min(value, turn) FILTER (WHERE "from" = 'gpt') AS caption,
       count(*) FILTER (WHERE "from" = 'gpt') AS n_caption_turns,
       CASE WHEN count(*) FILTER (WHERE "from" = 'gpt') = 0 THEN 'no ''gpt'' turn' END AS error
FROM turns GROUP BY id
""",
)

sql(
    "last_turn_flatten",
    f"""
WITH {TURNS}
SELECT id, arg_max(value, turn) AS conversations FROM turns GROUP BY id
""",
)

CAPTION_TR = f"""
first AS (
  SELECT id, arg_min(value, turn) FILTER (WHERE "from" = 'gpt') AS caption FROM turns GROUP BY id
), tr AS (
  SELECT id, caption, {strip_ws(reverse_words('caption'))} AS translation FROM first WHERE caption IS NOT NULL
)"""

sql(
    "replace_caption_turns",
    f"""
WITH {TURNS}, {CAPTION_TR}
SELECT t.id, t.turn, t."from",
       CASE WHEN t."from" = 'gpt' AND tr.translation <> '' THEN tr.translation ELSE t.value END AS value
FROM turns t LEFT JOIN tr ON t.id = tr.id
""",
)

sql(
    "strip_image_markup",
    f"""
WITH {TURNS}
SELECT id, turn,
       replace(value, '<image>', '') AS without_tag,
       replace(replace(value, chr(10) || '<image>', ''), '<image>' || chr(10), '') AS without_affix
FROM turns WHERE "from" = 'human'
""",
)


# ------------------------------------------------------ document blocks
LAB = """
lab AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.doc_id AS row_idx, d.text AS conversations,
         lpad(CAST(d.doc_id - least(d.doc_id // (c.n // 8), 7) * (c.n // 8) AS VARCHAR), greatest(9, length(CAST(d.doc_id AS VARCHAR)))::INTEGER, '0') AS id,
         ['ar','zh','en','fr','hi','jp','ru','es'][CAST(least(d.doc_id // (c.n // 8), 7) AS INTEGER) + 1] AS language
  FROM documents d CROSS JOIN (SELECT count(*) AS n FROM documents) c
)"""


def lang_name(x: str) -> str:
    pairs = [
        ("ar", "Arabic"), ("de", "German"), ("en", "English"), ("es", "Spanish"), ("fr", "French"),
        ("hi", "Hindi"), ("it", "Italian"), ("ja", "Japanese"), ("nl", "Dutch"), ("pt", "Portuguese"),
        ("ru", "Russian"), ("zh", "Chinese"),
    ]
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pairs)
    return f"(CASE CASE WHEN lower({x}) = 'jp' THEN 'ja' ELSE lower({x}) END {whens} END)"


def capitalize(x: str) -> str:
    return f"(upper(substr({x}, 1, 1)) || lower(substr({x}, 2)))"


sql("label_language_blocks", f"WITH {LAB} SELECT doc_id, id, language FROM lab")

sql(
    "normalise_language",
    f"""
WITH {LAB}
SELECT doc_id, lang, {lang_name('lang')} AS lang_name, language AS block_language,
       {lang_name('language')} AS block_language_name,
       {capitalize("concat_ws(' ', language, " + lang_name('language') + ")")} AS language_label
FROM lab
""",
)

sql(
    "unpivot_parallel",
    f"""
WITH {LAB}
SELECT e.id, e.text AS sentence, {lang_name('o.language')} AS lang, o.text AS translation
FROM lab e JOIN lab o ON e.id = o.id
WHERE e.language = 'en' AND o.language <> 'en'
""",
)

sql(
    "attach_reference_text",
    f"""
WITH {LAB}, ref AS (
  SELECT id, arg_max(conversations, row_idx) AS en_text FROM lab
  WHERE language = 'en' AND conversations <> '' GROUP BY id
)
SELECT l.doc_id, l.id, l.language,
       CASE WHEN l.language = 'en' THEN '' ELSE coalesce(r.en_text, 'id_not_found') END AS reference_text
FROM lab l LEFT JOIN ref r ON l.id = r.id
WHERE NOT (l.language IS NOT DISTINCT FROM 'en')
""",
)

sql(
    "attach_back_translations",
    f"""
WITH {LAB}
SELECT doc_id, id, language,
       CASE WHEN language IN ('ar','zh','fr','hi','jp','ru','es') THEN {reverse_words('conversations')} END
         AS back_translations
FROM lab
""",
)

sql(
    "caption_mismatch",
    """
SELECT lpad(CAST(doc_id AS VARCHAR), greatest(9, length(CAST(doc_id AS VARCHAR)))::INTEGER, '0') AS id, CAST(length(text) AS BIGINT) AS caption_len
FROM documents WHERE text <> replace(text, chr(10), ' ')
""",
)

sql(
    "equal_splits",
    """
SELECT doc_id, CAST(doc_id // (c.n // 3) AS BIGINT) AS split_no
FROM documents CROSS JOIN (SELECT count(*) AS n FROM documents) c
WHERE c.n // 3 > 0 AND doc_id // (c.n // 3) < 3
""",
)

sql(
    "union_datasets",
    """
SELECT doc_id, text, lang FROM documents
UNION ALL
SELECT item_id AS doc_id, text, CAST(NULL AS VARCHAR) AS lang FROM benchmark
""",
)


# ----------------------------------------------------------------- metrics
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"


def readability_cte(src: str, key: str, text: str) -> str:
    """CTE ``rd(key, fk_grade, f_ease, length)`` over table/CTE ``src``."""
    words = f"regexp_extract_all(regexp_replace(@X@, '{PUNCT_CLASS}', '', 'g'), '{NOT_WS_RUN}')"
    w_text = words.replace("@X@", text)
    w_piece = words.replace("@X@", "p")
    syl = (
        "greatest(1, len(regexp_extract_all(lower(w), '[aeiouy]+')) - "
        "CASE WHEN regexp_matches(lower(w), '[^aeiouy]e$') THEN 1 ELSE 0 END)"
    )
    return f"""
rc AS (
  SELECT {key} AS k, {text} AS t,
         len({w_text}) AS nw,
         greatest(1, len(list_filter(regexp_extract_all({text}, '[^.!?]+[.!?]*'), lambda p: len({w_piece}) > 2))) AS ns,
         coalesce(list_sum(list_transform({w_text}, lambda w: {syl})), 0) AS ny
  FROM {src}
), rd AS (
  SELECT k,
         CASE WHEN t IS NULL THEN 0.0 ELSE
           0.39 * (CASE WHEN nw > 0 THEN nw / ns ELSE 0.0 END)
           + 11.8 * (CASE WHEN nw > 0 THEN ny / nw ELSE 0.0 END) - 15.59 END AS fk_grade,
         CASE WHEN t IS NULL THEN 0.0 ELSE
           206.835 - 1.015 * (CASE WHEN nw > 0 THEN nw / ns ELSE 0.0 END)
           - 84.6 * (CASE WHEN nw > 0 THEN ny / nw ELSE 0.0 END) END AS f_ease,
         CAST(length(t) AS BIGINT) AS length
  FROM rc
)"""


COMPLEXITY = """
mm AS (SELECT min(fk_grade) AS gmin, max(fk_grade) AS gmax, min(f_ease) AS emin, max(f_ease) AS emax FROM rd),
cx AS (
  SELECT rd.*,
         CASE WHEN gmax > gmin THEN (fk_grade - gmin) / (gmax - gmin) ELSE 0.0 END AS fk_grade_norm,
         CASE WHEN emax > emin THEN (f_ease - emin) / (emax - emin) ELSE 0.0 END AS f_ease_norm
  FROM rd CROSS JOIN mm
), cy AS (
  SELECT cx.*, (fk_grade_norm + (1.0 - f_ease_norm)) / 2 AS complexity FROM cx
)"""

sql(
    "readability",
    f"""
WITH {readability_cte('documents', 'doc_id', 'text')}
SELECT k AS doc_id, round(fk_grade, 6) AS fk_grade, round(f_ease, 6) AS f_ease, length FROM rd
""",
)

sql(
    "complexity_score",
    f"""
WITH {readability_cte('documents', 'doc_id', 'text')}, {COMPLEXITY}
SELECT k AS doc_id, round(fk_grade_norm, 6) AS fk_grade_norm, round(f_ease_norm, 6) AS f_ease_norm,
       round(complexity, 6) AS complexity
FROM cy
""",
)

PAIRS = """
pairs AS (
  SELECT lpad(CAST(a.conv_id AS VARCHAR), greatest(9, length(CAST(a.conv_id AS VARCHAR)))::INTEGER, '0') AS id, a.turn, a.text AS hypothesis, b.text AS reference,
         array_to_string(list_filter(string_split(b.text, ' '), lambda x, i: (i - 1) % 5 <> 4), ' ') AS rewrite
  FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND a.turn = b.turn + 1
)"""

TOKEN_RE = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS_CHARS}]"

sql(
    "repeated_tokens",
    f"""
WITH {PAIRS}, tk AS (
  SELECT id, turn, regexp_extract_all(hypothesis, '{TOKEN_RE}') AS t, regexp_extract_all(reference, '{TOKEN_RE}') AS r
  FROM pairs
)
SELECT id, turn,
       coalesce(len(list_filter(
                    list_transform(list_filter(generate_series(1, len(t) - 1), lambda i: t[i] = t[i + 1]), lambda i: t[i]),
                    lambda x: NOT list_contains(r, x))) > 0, false) AS repeated_tokens
FROM tk
""",
)


def _lead_grams(val: str, n: int, sep: str) -> str:
    parts = [val] + [f"lead({val}, {j}) OVER w" for j in range(1, n)]
    return f" || {sep} || ".join(parts) if sep != "''" else " || ".join(parts)


def bleu_ctes(p: str) -> str:
    """From CTE ``p(k, v, hyp, ref)`` build ``bleu_out(k, v, bleu)``."""
    tok = f"regexp_extract_all(@X@, '{NOT_WS_RUN}')"
    terms = []
    for n in range(1, 5):
        terms.append(
            f"0.25 * ln(CASE WHEN m{n} > 0 THEN m{n} / greatest(1, c - {n} + 1) ELSE 2.2250738585072014e-308 END)"
        )
    logsum = "0.0"
    for t in terms:
        logsum = f"({logsum} + {t})"
    bgrams = ", ".join(f"{_lead_grams('t', n, chr(39) + ' ' + chr(39))} AS g{n}" for n in range(1, 5))
    bunion = "\n  UNION ALL ".join(
        f"SELECT k, v, hs, rs, {n} AS n, g{n} AS g FROM bw WHERE g{n} IS NOT NULL" for n in range(1, 5)
    )
    return f"""
bt AS (
  SELECT k, v, 1 AS hs, 0 AS rs, {tok.replace('@X@', 'hyp')} AS toks FROM {p}
  UNION ALL SELECT k, v, 0 AS hs, 1 AS rs, {tok.replace('@X@', 'ref')} AS toks FROM {p}
), bu AS (
  SELECT k, v, hs, rs, unnest(toks) AS t, unnest(range(1, len(toks) + 1)) AS pos FROM bt
), bw AS (
  SELECT k, v, hs, rs, {bgrams}
  FROM bu WINDOW w AS (PARTITION BY k, v, hs ORDER BY pos)
), bg AS (
  {bunion}
), bc AS (
  SELECT k, v, n, g, sum(hs) AS hc, sum(rs) AS rc FROM bg GROUP BY k, v, n, g
), bm AS (
  SELECT k, v, n, sum(least(hc, rc)) AS m FROM bc GROUP BY k, v, n
), bs AS (
  SELECT q.k, q.v, len({tok.replace('@X@', 'q.hyp')}) AS c, len({tok.replace('@X@', 'q.ref')}) AS r,
         coalesce(max(m) FILTER (WHERE n = 1), 0) AS m1, coalesce(max(m) FILTER (WHERE n = 2), 0) AS m2,
         coalesce(max(m) FILTER (WHERE n = 3), 0) AS m3, coalesce(max(m) FILTER (WHERE n = 4), 0) AS m4
  FROM {p} q LEFT JOIN bm ON q.k = bm.k AND q.v = bm.v
  GROUP BY q.k, q.v, q.hyp, q.ref
), bleu_out AS (
  SELECT k, v,
         CASE WHEN c = 0 OR m1 = 0 THEN 0.0
              ELSE (CASE WHEN c > r THEN 1.0 ELSE exp(1.0 - r / c) END) * exp({logsum}) END AS bleu
  FROM bs
)"""


def chrf_ctes(p: str, lowercase: bool = False, prefix: str = "") -> str:
    """From CTE ``p(k, v, hyp, ref)`` build ``chrf_st(k, v, n, h, r, m)`` and
    ``chrf_out(k, v, chrf)`` (names prefixed by ``prefix``). Characters and
    tokens are unnested once with their positions; n-grams come from
    ``lead`` windows (NULL past the end)."""
    lo = (lambda x: f"lower({x})") if lowercase else (lambda x: x)
    split = (
        "flatten(list_transform(regexp_extract_all(s, '" + NOT_WS_RUN + "'), lambda w: "
        "CASE WHEN length(w) = 1 THEN [w] "
        "WHEN regexp_matches(right(w, 1), '[[:punct:]]') THEN [left(w, length(w) - 1), right(w, 1)] "
        "WHEN regexp_matches(left(w, 1), '[[:punct:]]') THEN [left(w, 1), substr(w, 2)] "
        "ELSE [w] END))"
    )
    cgrams = ",\n         ".join(f"{_lead_grams('c', n, chr(39) * 2)} AS g{n}" for n in range(1, 7))
    char_union = "\n  UNION ALL ".join(
        f"SELECT k, v, hs, rs, {n} AS n, g{n} AS g FROM cw WHERE g{n} IS NOT NULL" for n in range(1, 7)
    )
    body = f"""
cs AS (
  SELECT k, v, 1 AS hs, 0 AS rs, {lo('hyp')} AS s FROM {p}
  UNION ALL SELECT k, v, 0 AS hs, 1 AS rs, {lo('ref')} AS s FROM {p}
), cc AS (
  SELECT k, v, hs, rs, regexp_extract_all(regexp_replace(s, '{WS}', '', 'g'), '(?s).') AS ch, {split} AS toks FROM cs
), cu AS (
  SELECT k, v, hs, rs, unnest(ch) AS c, unnest(range(1, len(ch) + 1)) AS pos FROM cc
), cw AS (
  SELECT k, v, hs, rs,
         {cgrams}
  FROM cu WINDOW w AS (PARTITION BY k, v, hs ORDER BY pos)
), wu AS (
  SELECT k, v, hs, rs, unnest(toks) AS t, unnest(range(1, len(toks) + 1)) AS pos FROM cc
), ww AS (
  SELECT k, v, hs, rs, t AS g1, t || ' ' || lead(t, 1) OVER w AS g2
  FROM wu WINDOW w AS (PARTITION BY k, v, hs ORDER BY pos)
), cg AS (
  {char_union}
  UNION ALL SELECT k, v, hs, rs, 7 AS n, g1 AS g FROM ww
  UNION ALL SELECT k, v, hs, rs, 8 AS n, g2 AS g FROM ww WHERE g2 IS NOT NULL
), ct AS (
  SELECT k, v, n, g, sum(hs) AS hc, sum(rs) AS rc FROM cg GROUP BY k, v, n, g
), chrf_st AS (
  SELECT k, v, n, CASE WHEN sum(rc) > 0 THEN sum(hc) ELSE 0 END AS h, sum(rc) AS r, sum(least(hc, rc)) AS m
  FROM ct GROUP BY k, v, n
), cf AS (
  SELECT q.k, q.v,
         coalesce(sum(CASE WHEN h > 0 AND r > 0 THEN m / h ELSE 0.0 END), 0.0) AS ps,
         coalesce(sum(CASE WHEN h > 0 AND r > 0 THEN m / r ELSE 0.0 END), 0.0) AS rs,
         count(*) FILTER (WHERE h > 0 AND r > 0) AS eff
  FROM {p} q LEFT JOIN chrf_st st ON q.k = st.k AND q.v = st.v
  GROUP BY q.k, q.v
), chrf_out AS (
  SELECT k, v,
         CASE WHEN eff = 0 OR (ps / eff) + (rs / eff) = 0 THEN 0.0
              ELSE 100.0 * ((5.0 * (ps / eff)) * (rs / eff) / ((4.0 * (ps / eff)) + (rs / eff))) END AS chrf
  FROM cf
)"""
    if not prefix:
        return body
    import re

    names = ["chrf_st", "chrf_out", "cs", "cc", "cu", "cw", "wu", "ww", "cg", "ct", "cf"]
    return re.sub(r"\b(" + "|".join(names) + r")\b(?= AS \(|\s|$|,)", lambda m: prefix + m.group(1), body)


CHRF_CORPUS = """
corpus AS (
  SELECT n, sum(h) AS h, sum(r) AS r, sum(m) AS m FROM chrf_st GROUP BY n
), corpus_f AS (
  SELECT sum(CASE WHEN h > 0 AND r > 0 THEN m / h ELSE 0.0 END) AS ps,
         sum(CASE WHEN h > 0 AND r > 0 THEN m / r ELSE 0.0 END) AS rs,
         count(*) FILTER (WHERE h > 0 AND r > 0) AS eff
  FROM corpus
)"""

BLEU_PAIRS = f"""{PAIRS}, bp AS (
  SELECT id || ':' || CAST(turn AS VARCHAR) AS k, 'plain' AS v, hypothesis AS hyp, reference AS ref FROM pairs
  UNION ALL
  SELECT id || ':' || CAST(turn AS VARCHAR) AS k, 'rewrite' AS v, rewrite AS hyp, reference AS ref FROM pairs
)"""

sql(
    "sentence_bleu",
    f"""
WITH {BLEU_PAIRS}, {bleu_ctes('bp')}
SELECT p.id, p.turn,
       round(max(b.bleu) FILTER (WHERE b.v = 'plain'), 6) AS bleu,
       round(max(b.bleu) FILTER (WHERE b.v = 'rewrite'), 6) AS bleu_rewrite
FROM pairs p JOIN bleu_out b ON b.k = p.id || ':' || CAST(p.turn AS VARCHAR)
GROUP BY p.id, p.turn
""",
)

sql(
    "sentence_chrf",
    f"""
WITH {BLEU_PAIRS}, {chrf_ctes('bp')},
lp AS (SELECT k, 'lower' AS v, hyp, ref FROM bp WHERE v = 'rewrite'),
{chrf_ctes('lp', lowercase=True, prefix='l')}
SELECT p.id, p.turn,
       round(max(c.chrf) FILTER (WHERE c.v = 'plain'), 6) AS chrf,
       round(max(c.chrf) FILTER (WHERE c.v = 'rewrite'), 6) AS chrf_rewrite,
       round(max(l.chrf), 6) AS chrf_rewrite_lower
FROM pairs p
JOIN chrf_out c ON c.k = p.id || ':' || CAST(p.turn AS VARCHAR)
JOIN lchrf_out l ON l.k = p.id || ':' || CAST(p.turn AS VARCHAR)
GROUP BY p.id, p.turn
""",
)


def _corpus_score(cte: str) -> str:
    return f"""(SELECT CASE WHEN eff = 0 OR (ps / eff) + (rs / eff) = 0 THEN 0.0
       ELSE 100.0 * ((5.0 * (ps / eff)) * (rs / eff) / ((4.0 * (ps / eff)) + (rs / eff))) END FROM {cte})"""


sql(
    "corpus_chrf",
    f"""
WITH {BLEU_PAIRS}, {chrf_ctes('bp')},
corpus AS (SELECT v, n, sum(h) AS h, sum(r) AS r, sum(m) AS m FROM chrf_st GROUP BY v, n),
corpus_f AS (
  SELECT v, sum(CASE WHEN h > 0 AND r > 0 THEN m / h ELSE 0.0 END) AS ps,
         sum(CASE WHEN h > 0 AND r > 0 THEN m / r ELSE 0.0 END) AS rs,
         count(*) FILTER (WHERE h > 0 AND r > 0) AS eff
  FROM corpus GROUP BY v
), sc AS (
  SELECT v, CASE WHEN eff = 0 OR (ps / eff) + (rs / eff) = 0 THEN 0.0
       ELSE 100.0 * ((5.0 * (ps / eff)) * (rs / eff) / ((4.0 * (ps / eff)) + (rs / eff))) END AS s FROM corpus_f
)
SELECT (SELECT count(*) FROM pairs) AS n_pairs,
       round((SELECT s FROM sc WHERE v = 'plain'), 6) AS chrf,
       round((SELECT s FROM sc WHERE v = 'rewrite'), 6) AS chrf_rewrite
""",
)

sql(
    "chrf_flag",
    f"""
WITH {PAIRS}, rp AS (
  SELECT id || ':' || CAST(turn AS VARCHAR) AS k, 'rewrite' AS v, rewrite AS hyp, reference AS ref FROM pairs
), {chrf_ctes('rp')}
SELECT p.id, p.turn, round(c.chrf, 6) AS back_translate_chrf,
       CASE WHEN c.chrf >= 0.5 THEN 0 ELSE 1 END AS back_translate_chrf_int,
       CASE WHEN c.chrf >= 50.0 THEN 0 ELSE 1 END AS chrf_below_50
FROM pairs p JOIN chrf_out c ON c.k = p.id || ':' || CAST(p.turn AS VARCHAR)
""",
)


# ---------------------------------------------------------------- sampling
def qbins(src: str, col: str, n: int, out: str) -> str:
    probs = ", ".join(repr(i / n) for i in range(n + 1))
    return f"""(
  SELECT len(list_filter(e[2:len(e) - 1], lambda x: x < round(CAST({col} AS DOUBLE), 9)))
  FROM (SELECT list_sort(list_distinct(list_transform(quantile_cont(CAST({col} AS DOUBLE), [{probs}]),
                                                      lambda x: round(x, 9)))) AS e FROM {src})
) AS {out}"""


sql(
    "quantile_bins",
    f"""
WITH edges AS (
  SELECT list_sort(list_distinct(list_transform(quantile_cont(CAST(n_chars AS DOUBLE), [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]),
                                                lambda x: round(x, 9)))) AS e FROM documents
)
SELECT doc_id, CAST(len(list_filter(e[2:len(e) - 1], lambda x: x < round(CAST(n_chars AS DOUBLE), 9))) AS INTEGER) AS length_bin
FROM documents CROSS JOIN edges
""",
)

sql(
    "width_bins",
    """
WITH b AS (SELECT CAST(min(n_chars) AS DOUBLE) AS lo, CAST(max(n_chars) AS DOUBLE) AS hi FROM documents)
SELECT doc_id,
       CAST(CASE WHEN hi > lo THEN least(4, greatest(0, ceil(round((n_chars - lo) / ((hi - lo) / 5), 9)) - 1)) ELSE 0 END
            AS INTEGER) AS length_bin
FROM documents CROSS JOIN b
""",
)

REPEAT_FLAG = f"""
rw AS (
  SELECT doc_id, regexp_extract_all(lower(text), '{WORD_RUN}') AS words FROM documents
), rwc AS (
  SELECT doc_id, x, count(*) AS c FROM (SELECT doc_id, unnest(words) AS x FROM rw) GROUP BY doc_id, x
), rwm AS (
  SELECT doc_id, max(c) AS mx FROM rwc GROUP BY doc_id
), rflag AS (
  SELECT rw.doc_id,
         CASE WHEN len(rw.words) = 0 THEN false
              WHEN len(rw.words) = 2 THEN rw.words[1] = rw.words[2]
              ELSE (coalesce(rwm.mx, 0) / len(rw.words))
                   > least(greatest(0.8 * exp(-0.05 * len(rw.words)) + 0.3, 0.3), 0.8)
         END AS flagged
  FROM rw LEFT JOIN rwm ON rw.doc_id = rwm.doc_id
)"""


def sample_sql(n_samples: int, n_bins: int) -> str:
    probs = ", ".join(repr(i / n_bins) for i in range(n_bins + 1))

    def lab(col: str, edges: str) -> str:
        return f"len(list_filter({edges}[2:len({edges}) - 1], lambda x: x < round(CAST({col} AS DOUBLE), 9)))"

    return f"""
WITH {readability_cte('documents', 'doc_id', 'text')}, {COMPLEXITY}, {REPEAT_FLAG},
kept AS (SELECT cy.* FROM cy JOIN rflag ON cy.k = rflag.doc_id WHERE NOT rflag.flagged),
ed AS (
  SELECT list_sort(list_distinct(list_transform(quantile_cont(complexity, [{probs}]), lambda x: round(x, 9)))) AS ce,
         list_sort(list_distinct(list_transform(quantile_cont(CAST(length AS DOUBLE), [{probs}]), lambda x: round(x, 9)))) AS le
  FROM kept
), binned AS (
  SELECT kept.*, CAST({lab('complexity', 'ce')} AS VARCHAR) || '_' || CAST({lab('length', 'le')} AS VARCHAR) AS strata
  FROM kept CROSS JOIN ed
), sc AS (
  SELECT strata, count(*) AS c FROM binned GROUP BY strata
), tot AS (SELECT sum(c) AS total FROM sc),
q0 AS (
  SELECT strata, c, ({n_samples} * c) // total AS q, ({n_samples} * c) % total AS rem, total FROM sc CROSS JOIN tot
), rk AS (
  SELECT *, row_number() OVER (ORDER BY rem DESC, strata) AS r FROM q0
), lft AS (SELECT {n_samples} - sum(q) AS l FROM q0),
quota AS (
  SELECT strata, CASE WHEN {n_samples} >= total THEN c ELSE least(c, q + CASE WHEN r <= l THEN 1 ELSE 0 END) END AS quota
  FROM rk CROSS JOIN lft
), ranked AS (
  SELECT b.*, row_number() OVER (PARTITION BY b.strata ORDER BY md5('42|' || CAST(b.k AS VARCHAR)), b.k) AS rn
  FROM binned b
)
SELECT r.k AS doc_id, round(r.complexity, 6) AS complexity, r.length, round(r.fk_grade, 6) AS fk_grade,
       round(r.f_ease, 6) AS f_ease
FROM ranked r JOIN quota q ON r.strata = q.strata
WHERE r.rn <= q.quota
"""


sql("stratified_sample", sample_sql(30, 5))


# --------------------------------------------------------------- profiling
sql(
    "profile_conversations",
    f"""
WITH {TURNS},
pc AS (SELECT id, count(*) AS n FROM turns GROUP BY id),
meta AS (
  SELECT id, replace(arg_max(value, turn) FILTER (WHERE "from" = 'gpt'), chr(10), ' ') AS blip_caption
  FROM turns GROUP BY id
)
SELECT (SELECT count(*) FROM pc) AS n_conversations,
       (SELECT CAST(sum(n) AS BIGINT) FROM pc) AS n_turns,
       (SELECT count(*) FROM pc WHERE n > 2) AS n_multi_turn,
       (SELECT count(DISTINCT value) FROM turns WHERE "from" = 'human') AS n_instructions_tagged,
       (SELECT count(DISTINCT replace(replace(value, chr(10) || '<image>', ''), '<image>' || chr(10), ''))
          FROM turns WHERE "from" = 'human') AS n_instructions_untagged,
       (SELECT count(*) FROM turns t JOIN meta m ON t.id = m.id
          WHERE t."from" = 'gpt' AND t.value IS DISTINCT FROM m.blip_caption) AS n_caption_mismatch
""",
)

sql(
    "distinct_instructions",
    f"""
WITH {TURNS}
SELECT DISTINCT replace(replace(value, chr(10) || '<image>', ''), '<image>' || chr(10), '') AS instruction
FROM turns WHERE "from" = 'human'
""",
)


def json_len(x: str) -> str:
    def cnt(cls: str) -> str:
        return f"(length({x}) - length(regexp_replace({x}, '{cls}', '', 'g')))"

    return (
        f"(length({x}) + {cnt(r'[\"\\\x{08}\x{0c}\n\r\t]')} + 5 * {cnt(r'[\x{00}-\x{07}\x{0b}\x{0e}-\x{1f}\x{7f}]')}"
        f" + 5 * {cnt(r'[\x{80}-\x{ffff}]')} + 11 * {cnt(r'[\x{10000}-\x{10ffff}]')})"
    )


sql(
    "length_ordered_batches",
    f"""
WITH {TURNS},
lens AS (
  SELECT id, CAST(2 + sum(25 + {json_len('"from"')} + {json_len('value')}) + 2 * (count(*) - 1) AS BIGINT) AS json_len
  FROM turns GROUP BY id
), b AS (
  SELECT id, CAST(id AS BIGINT) AS row_idx, CAST(floor(CAST(id AS BIGINT) / 10) AS BIGINT) AS batch_id, json_len FROM lens
)
SELECT id, batch_id, json_len,
       row_number() OVER (PARTITION BY batch_id ORDER BY json_len, row_idx) AS position_in_batch
FROM b
""",
)

RAW = r"""
raw AS (
  SELECT doc_id, n_chars,
         ([chr(12288), ' ', chr(9), chr(160), chr(10)][n_chars % 5 + 1]) AS pad,
         CASE WHEN n_chars % 7 = 0 THEN '' ELSE text END AS body
  FROM documents
), resp AS (
  SELECT doc_id, n_chars, pad || body || pad || pad AS response FROM raw
)"""

sql(
    "clean_response",
    f"""
WITH {RAW}
SELECT doc_id, CAST(n_chars AS VARCHAR) AS message,
       CASE WHEN {strip_ws('response')} <> '' THEN {strip_ws('response')} END AS translation,
       CASE WHEN {strip_ws('response')} = '' THEN 'empty_response: ' || response END AS error
FROM resp
""",
)

sql(
    "failure_summary",
    f"""
WITH {RAW}
SELECT CASE WHEN {strip_ws('response')} = '' THEN 'empty_response' END AS error_kind,
       count(*) AS n
FROM resp GROUP BY 1
""",
)


# ------------------------------------------------------------------ prompts
PAIRS_LONG = f"""{LAB},
long AS (
  SELECT e.id, e.text AS sentence, {lang_name('o.language')} AS lang, o.text AS translation
  FROM lab e JOIN lab o ON e.id = o.id WHERE e.language = 'en' AND o.language <> 'en'
), prompts AS (
  SELECT * FROM (VALUES
    (0, 'hindi', 'You translate English captions into Hindi. Answer with the translation only.', '{{message}}'),
    (1, 'FRENCH', 'You translate English captions into French. Answer with the translation only.', 'Translate: {{message}}'),
    (2, 'spanish', '', '{{message}}'),
    (3, 'aRABIC', 'You translate English captions into Arabic.', '{{message}}'),
    (4, 'Chinese', 'You translate English captions into Chinese.', 'Into Chinese: {{message}}'),
    (5, 'japanese', 'You translate English captions into Japanese.', ' '),
    (6, 'RUSSIAN', 'You translate English captions into Russian.', '{{message}} ({{message}})')
  ) t(prompt_idx, translate_to, preamble, message)
), pl AS (
  SELECT CAST(prompt_idx AS BIGINT) AS prompt_idx, translate_to, preamble, message,
         {capitalize('translate_to')} AS lang,
         CASE WHEN trim(translate_to) = '' THEN 'target_blank'
              WHEN trim(preamble) = '' OR trim(message) = ''
                THEN 'prompt_blank'
         END AS validation_error
  FROM prompts
)"""

sql(
    "render_prompts",
    f"""
WITH {PAIRS_LONG}
SELECT pl.prompt_idx, l.lang, l.id, 'Input: ' || l.sentence AS message,
       replace(pl.message, '{{message}}', l.sentence) AS rendered, pl.validation_error
FROM long l JOIN pl ON l.lang = pl.lang
""",
)

sql(
    "prompt_evaluation",
    f"""
WITH {PAIRS_LONG},
ev AS (
  SELECT pl.prompt_idx, l.lang, l.id, l.sentence AS English, l.translation AS Ground_truth,
         {reverse_words("'Input: ' || l.sentence")} AS Model_output
  FROM long l JOIN pl ON l.lang = pl.lang
), bp AS (
  SELECT CAST(prompt_idx AS VARCHAR) || ':' || id AS k, 'plain' AS v, Model_output AS hyp, Ground_truth AS ref FROM ev
), {bleu_ctes('bp')}
SELECT ev.prompt_idx, ev.lang, ev.English, ev.Ground_truth, ev.Model_output, round(b.bleu, 6) AS Bleu_score
FROM ev JOIN bleu_out b ON b.k = CAST(ev.prompt_idx AS VARCHAR) || ':' || ev.id
""",
)

ORACLE["prompt_file_evaluation"] = ORACLE["prompt_evaluation"]

sql(
    "translation_memory",
    f"""
WITH {LAB},
mem AS (
  SELECT e.text AS sentence, min(o.text) AS translation
  FROM lab e JOIN lab o ON e.id = o.id WHERE e.language = 'en' AND o.language = 'hi' GROUP BY e.text
), inp AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<image>' || chr(10) || text ELSE text || chr(10) || '<image>' END AS t
  FROM lab WHERE language = 'en'
)
SELECT i.doc_id,
       CASE WHEN starts_with(i.t, '<image>' || chr(10)) THEN '<image>' || chr(10) || m.translation
            WHEN ends_with(i.t, chr(10) || '<image>') THEN m.translation || chr(10) || '<image>'
            ELSE m.translation END AS translation
FROM inp i LEFT JOIN mem m
  ON replace(replace(i.t, chr(10) || '<image>', ''), '<image>' || chr(10), '') = m.sentence
""",
)

# ------------------------------------------------------ resume / streaming
AUDIT = f"""
WITH {TURNS}, {CAPTION_TR}
SELECT id AS "ID", caption AS "GPT Value Original", translation AS "GPT Value Modified"
FROM tr WHERE translation <> ''
"""
sql("translate_pipeline", AUDIT)
sql("resume_translation", AUDIT)
sql("incremental_first_captions", AUDIT)

sql(
    "paced_translation",
    f"""
WITH {TURNS}, first AS (
  SELECT id, arg_min(value, turn) FILTER (WHERE "from" = 'gpt') AS caption FROM turns GROUP BY id
)
SELECT id, CASE WHEN {strip_ws(reverse_words('caption'))} <> '' THEN {strip_ws(reverse_words('caption'))} END AS translation,
       CASE WHEN caption IS NULL THEN 'No text'
            WHEN {strip_ws(reverse_words('caption'))} = '' THEN 'empty_response: ' || {reverse_words('caption')} END AS error
FROM first
""",
)

sql(
    "stream_translate",
    f"""
SELECT lpad(CAST(conv_id AS VARCHAR), greatest(9, length(CAST(conv_id AS VARCHAR)))::INTEGER, '0') AS id, turn, text AS original,
       CASE WHEN {strip_ws(reverse_words('text'))} <> '' THEN {strip_ws(reverse_words('text'))} END AS translation,
       CASE WHEN {strip_ws(reverse_words('text'))} = ''
            THEN 'empty_response: ' || {reverse_words('text')} END AS error
FROM conversations WHERE role = 'assistant'
""",
)

# ---------------------------------------------------------------- pipelines
sql(
    "validation_pipeline",
    f"""
WITH {LAB},
ref AS (
  SELECT id, arg_max(conversations, row_idx) AS en_text FROM lab
  WHERE language = 'en' AND conversations <> '' GROUP BY id
), v AS (
  SELECT l.doc_id, l.id, l.language, l.conversations,
         {reverse_words('l.conversations')} AS back_translations,
         coalesce(r.en_text, 'id_not_found') AS reference_text
  FROM lab l LEFT JOIN ref r ON l.id = r.id
  WHERE l.language <> 'en'
), tk AS (
  SELECT doc_id, regexp_extract_all(conversations, '{TOKEN_RE}') AS t, regexp_extract_all(reference_text, '{TOKEN_RE}') AS r
  FROM v
), rt AS (
  SELECT doc_id,
         coalesce(len(list_filter(
                    list_transform(list_filter(generate_series(1, len(t) - 1), lambda i: t[i] = t[i + 1]), lambda i: t[i]),
                    lambda x: NOT list_contains(r, x))) > 0, false) AS repeated_tokens
  FROM tk
), vp AS (
  SELECT CAST(doc_id AS VARCHAR) AS k, 'plain' AS v, back_translations AS hyp, reference_text AS ref FROM v
), {chrf_ctes('vp')}
SELECT v.doc_id, v.id, v.language, rt.repeated_tokens, round(c.chrf, 6) AS back_translate_chrf,
       CASE WHEN c.chrf >= 0.5 THEN 0 ELSE 1 END AS back_translate_chrf_int
FROM v JOIN rt ON v.doc_id = rt.doc_id JOIN chrf_out c ON c.k = CAST(v.doc_id AS VARCHAR)
""",
)

_sample_text = sample_sql(30, 5).replace(
    """SELECT r.k AS doc_id, round(r.complexity, 6) AS complexity, r.length, round(r.fk_grade, 6) AS fk_grade,
       round(r.f_ease, 6) AS f_ease""",
    "SELECT d.text",
).replace("FROM ranked r JOIN quota q ON r.strata = q.strata", "FROM ranked r JOIN quota q ON r.strata = q.strata JOIN documents d ON d.doc_id = r.k")
sql("curation_pipeline", _sample_text)

sql(
    "parallel_csv_roundtrip",
    f"""
WITH {LAB}
SELECT e.text AS sentence, {lang_name('o.language')} AS lang, o.text AS translation
FROM lab e JOIN lab o ON e.id = o.id
WHERE e.language = 'en' AND o.language <> 'en'
""",
)


# ---------------------------------------- from file to result, and checks
sql(
    "nested_turn_values",
    f"""
WITH {TURNS}
SELECT id,
       coalesce(arg_max(value, turn) FILTER (WHERE "from" = 'human'), '') AS human_value,
       coalesce(arg_max(value, turn) FILTER (WHERE "from" = 'gpt'), '') AS gpt_value,
       arg_min(value, turn) FILTER (WHERE "from" = 'gpt') AS caption,
       count(*) > 2 AS multi_turn,
       arg_max(value, turn) AS last_value
FROM turns GROUP BY id
""",
)

sql(
    "file_translate_pipeline",
    f"""
WITH {TURNS}, {CAPTION_TR}
SELECT t.id, row_number() OVER (PARTITION BY t.id ORDER BY t.turn) - 1 AS turn, t."from",
       CASE WHEN t."from" = 'gpt' AND tr.translation <> '' THEN tr.translation ELSE t.value END AS value
FROM turns t LEFT JOIN tr ON t.id = tr.id
""",
)

ORACLE["profile_with_metadata"] = ORACLE["profile_conversations"].replace(
    """replace(arg_max(value, turn) FILTER (WHERE "from" = 'gpt'), chr(10), ' ') AS blip_caption
  FROM turns GROUP BY id""",
    """arg_min(value, turn) AS blip_caption FROM turns WHERE "from" = 'gpt' GROUP BY id""",
)

SPLITS = """
sp AS (
  SELECT doc_id, text AS conversations, CASE doc_id % 4 WHEN 0 THEN 'test' WHEN 1 THEN NULL ELSE 'train' END AS split,
         CASE WHEN doc_id % 4 < 2 THEN doc_id // 4 ELSE doc_id // 4 * 2 + doc_id % 4 - 2 END AS row_idx
  FROM documents
)"""
sql("published_splits", f"WITH {SPLITS} SELECT doc_id, split, row_idx, CAST(length(conversations) AS BIGINT) AS n FROM sp")

LAB_BY_SPLIT = SPLITS + """,
lab AS (
  SELECT s.doc_id, s.split, s.row_idx, s.conversations,
         lpad(CAST(s.row_idx - least(s.row_idx // (c.n // 8), 7) * (c.n // 8) AS VARCHAR), greatest(9, length(CAST(s.row_idx AS VARCHAR)))::INTEGER, '0') AS id,
         ['ar','zh','en','fr','hi','jp','ru','es'][CAST(least(s.row_idx // (c.n // 8), 7) AS INTEGER) + 1] AS language
  FROM sp s JOIN (SELECT split, count(*) AS n FROM sp GROUP BY split) c ON s.split IS NOT DISTINCT FROM c.split
)"""
_by_split = ORACLE["validation_pipeline"].replace(LAB, LAB_BY_SPLIT)
_by_split = _by_split.replace("SELECT id, arg_max(conversations, row_idx) AS en_text", "SELECT split, id, arg_max(conversations, row_idx) AS en_text")
_by_split = _by_split.replace("conversations <> '' GROUP BY id", "conversations <> '' GROUP BY split, id")
_by_split = _by_split.replace("ON l.id = r.id", "ON l.id = r.id AND l.split IS NOT DISTINCT FROM r.split")
_by_split = _by_split.replace("SELECT l.doc_id, l.id,", "SELECT l.doc_id, l.split, l.id,").replace("SELECT v.doc_id, v.id,", "SELECT v.doc_id, v.split, v.id,")
ORACLE["validation_by_split"] = _by_split

ORACLE["validation_column_guard"] = ORACLE["validation_pipeline"].replace(
    "SELECT v.doc_id, v.id, v.language, rt.repeated_tokens,", "SELECT v.doc_id, v.language,"
)

sql("keep_language", f"WITH {LAB} SELECT doc_id, id, language FROM lab WHERE language = 'fr'")

sql(
    "strata_report",
    """
WITH d AS (
  SELECT CAST(len(string_split(text, chr(10))) AS DOUBLE) AS x, CAST(n_chars AS DOUBLE) AS y FROM documents
), b AS (
  SELECT *, min(x) OVER () AS x0, (max(x) OVER () - min(x) OVER ()) / 4 AS xw, min(y) OVER () AS y0, (max(y) OVER () - min(y) OVER ()) / 4 AS yw FROM d
), l AS (
  SELECT CAST(least(3, greatest(0, ceil(round((x - x0) / xw, 9)) - 1)) AS INTEGER) AS i, CAST(least(3, greatest(0, ceil(round((y - y0) / yw, 9)) - 1)) AS INTEGER) AS j FROM b
), g AS (
  SELECT a.i || '_' || c.j AS strata, (SELECT count(*) FROM l WHERE l.i = a.i AND l.j = c.j) AS n
  FROM (SELECT unnest(range(4)) AS i) a, (SELECT unnest(range(4)) AS j) c
)
SELECT strata, n, CASE WHEN n = 0 THEN 'empty' WHEN n < 2000 / 16.0 THEN 'few' END AS warning FROM g
""",
)

ORACLE["ranked_sample"] = (
    "SELECT row_number() OVER (ORDER BY c, doc_id) AS place, doc_id FROM ("
    + ORACLE["stratified_sample"].replace("round(r.complexity, 6) AS complexity, r.length, round(r.fk_grade, 6) AS fk_grade,\n       round(r.f_ease, 6) AS f_ease", "r.complexity AS c")
    + ")"
)

sql(
    "row_index_batches",
    """
WITH r AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx, (SELECT count(*) FROM labels) AS n FROM labels
)
SELECT doc_id, row_idx, row_idx // 100 AS batch_id, CASE WHEN row_idx // (n // 3) < 3 THEN row_idx // (n // 3) END AS split_no FROM r
""",
)
sql(
    "trial_rows",
    """
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_idx FROM labels)
SELECT doc_id, row_idx, row_idx < 5 AS head FROM r WHERE row_idx < 50
""",
)


def _catalogue_values() -> str:
    from babelframe.operators.prompts import catalogue_rows

    return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r[:3]) + ")" for r in catalogue_rows())


sql(
    "catalogue_prompts",
    f"""
WITH {LAB}, c(lang, direction, preamble) AS (VALUES {_catalogue_values()})
SELECT l.language, c.direction, count(*) AS n_rows, c.preamble, 3 AS n_examples
FROM lab l JOIN c ON c.lang = CASE l.language WHEN 'jp' THEN 'ja' ELSE l.language END
WHERE l.language <> 'en' GROUP BY l.language, c.direction, c.preamble
""",
)
