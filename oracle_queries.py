"""SQL twins of the registered queries, for DuckDB over the same tables.

Written from the definitions, with plain windows, self-joins and quantiles,
so that they check the distributed forms rather than repeat them.
"""

from __future__ import annotations

from chaffsieve import AuditConfig
from chaffsieve.functions.text import PROMPT_CLASSES, READABILITY_LEVELS, WHITESPACE
from chaffsieve.plans.queries import SHARES, SMALL_VOCABULARY, STEPS
from chaffsieve.schema import QUALITY_FLAGS
from chaffsieve.sources.corpus import (
    CLUSTER_NAMES,
    CONVERSATION_CLUSTER,
    LANGUAGE_CLUSTERS,
    PAGE_CLUSTER,
    PREFIX_VERBS,
    TURN_SPAN,
)

CFG = AuditConfig()
# The white-space set as the inside of an RE2 character class.
WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lits(texts) -> str:
    return ", ".join(lit(t) for t in texts)


BLANKS = lit(WHITESPACE)


def half_up(num: str, den: str, scale: int, digits: int) -> str:
    """round(scale * num / den, digits) on whole numbers, half away from zero."""
    by = scale * 10**digits
    size = f"((abs({num})::BIGINT * {2 * by} + ({den})::BIGINT) // (2 * ({den})::BIGINT))"
    signed = f"(CASE WHEN ({num}) < 0 THEN -{size} ELSE {size} END)"
    return f"(CASE WHEN ({den}) > 0 THEN {signed} / {10 ** digits}.0::DOUBLE END)"


def pct(num: str, den: str, digits: int = 2) -> str:
    return half_up(num, den, 100, digits)


def avg(total: str, count: str, digits: int = 1) -> str:
    return half_up(total, count, 1, digits)


# ---- corpora ---------------------------------------------------------------

LANG_CASE = "CASE lang " + " ".join(
    f"WHEN {lit(k)} THEN {v}" for k, v in LANGUAGE_CLUSTERS.items()
) + " END"

DOCUMENTS = f"""
SELECT doc_id AS order_key, split_part(text, chr(10), 1) AS instruction, '' AS input,
       text AS output, {LANG_CASE} AS cluster_id
FROM documents
"""

DOCUMENTS_WHOLE = f"""
SELECT doc_id AS order_key, text AS instruction, '' AS input, text AS output,
       {LANG_CASE} AS cluster_id
FROM documents
"""

DOCUMENTS_PREFIXED = f"""
SELECT order_key,
       ([{lits(PREFIX_VERBS)}])[(length(instruction) % {len(PREFIX_VERBS)}) + 1]
           || ' ' || instruction AS instruction,
       input, output, cluster_id
FROM ({DOCUMENTS})
"""

CONVERSATIONS = f"""
SELECT a.conv_id * {TURN_SPAN} + a.turn AS order_key, a.text AS instruction,
       coalesce((SELECT arg_min(s.text, s.turn) FROM conversations s
                 WHERE s.conv_id = a.conv_id AND s.role = 'system'), '') AS input,
       b.text AS output, {CONVERSATION_CLUSTER} AS cluster_id
FROM conversations a
JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1
WHERE a.role = 'user' AND b.role = 'assistant'
"""

PAGES = f"""
SELECT page_id AS order_key, url AS instruction, '' AS input, html AS output,
       {PAGE_CLUSTER} AS cluster_id
FROM pages
"""

MIXED = f"""
SELECT * REPLACE (order_key * 3 AS order_key) FROM ({DOCUMENTS_PREFIXED})
UNION ALL
SELECT * REPLACE (order_key * 3 + 1 AS order_key) FROM ({CONVERSATIONS})
UNION ALL
SELECT * REPLACE (order_key * 3 + 2 AS order_key) FROM ({PAGES})
"""


def cleaned(raw: str) -> str:
    return f"""
raw_rows AS MATERIALIZED ({raw}),
stripped AS (
    SELECT order_key, cluster_id,
           trim(coalesce(instruction, ''), {BLANKS}) AS instruction,
           trim(coalesce(input, ''), {BLANKS}) AS input_text,
           trim(coalesce(output, ''), {BLANKS}) AS output
    FROM raw_rows),
cleaned AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY order_key) AS row_id, instruction, input_text, output,
           cluster_id,
           (row_number() OVER (PARTITION BY instruction, input_text ORDER BY order_key) > 1)::INT
               AS is_exact_duplicate
    FROM stripped WHERE instruction <> '' AND output <> '')"""


# ---- features --------------------------------------------------------------


def words_of(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[{WS}]+'), lambda w: w <> '')"


CODE_HITS = " + ".join(f"contains(output, {lit(m)})::INT" for m in CFG.code_markers)
HEAD = f"ltrim(lower(instruction), {BLANKS})"
PROMPT_CASE = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"starts_with({HEAD}, {lit(p)})" for p in phrases) + f" THEN {lit(name)}"
    for name, phrases in PROMPT_CLASSES
) + " ELSE 'Other' END"
LEVEL_CASE = (
    "CASE WHEN flesch_score IS NULL THEN 'not scored' "
    + " ".join(f"WHEN flesch_score >= {b} THEN {lit(n)}" for b, n in READABILITY_LEVELS)
    + " ELSE 'extremely complex' END"
)

# The following words of an n-gram; NULL where the text ends first.
GRAM_REST = " ".join(f"|| ' ' || lead(w, {k}) OVER r" for k in range(1, CFG.repeat_ngram_n))

FEATURES = f"""
counted AS MATERIALIZED (
    SELECT *,
        trim(regexp_replace(lower(instruction), '[^a-z]+', ' ', 'g')) AS instruction_clean,
        (length(input_text) > 0)::INT AS has_input,
        len({words_of("instruction")}) AS instruction_word_count,
        len({words_of("output")}) AS output_word_count,
        greatest(len(list_filter(regexp_split_to_array(output, '[.!?]+'),
                                 lambda p: trim(p, {BLANKS}) <> '')), 1) AS sentence_count,
        ({CODE_HITS} >= {CFG.code_marker_min_hits})::INT AS is_code_like,
        {PROMPT_CASE} AS prompt_type_rule
    FROM cleaned),
syllables AS MATERIALIZED (
    SELECT row_id, sum(greatest(1, n - (n > 1 AND regexp_matches(w, '[^aeiouyl]e$'))::INT)) AS syl
    FROM (SELECT row_id, w, len(regexp_extract_all(w, '[aeiouy]+')) AS n
          FROM (SELECT row_id, regexp_replace(unnest({words_of("lower(output)")}),
                                              '[^a-z]', '', 'g') AS w
                FROM counted))
    GROUP BY row_id),
scored AS MATERIALIZED (
    SELECT counted.*,
        round_even(output_word_count / sentence_count, 2) AS words_per_sentence,
        CASE WHEN is_code_like = 0 THEN
            round_even(206.835::DOUBLE - 1.015::DOUBLE * (output_word_count / sentence_count)
                       - 84.6::DOUBLE * (syl / output_word_count), 2) END AS flesch_score
    FROM counted JOIN syllables USING (row_id)),
spoken AS (
    SELECT row_id, unnest(t) AS w, generate_subscripts(t, 1) AS i
    FROM (SELECT row_id, {words_of("lower(output)")} AS t FROM counted)
    WHERE len(t) >= {CFG.repeat_ngram_n * CFG.repeat_ngram_min_count}),
grams AS (
    SELECT row_id, w {GRAM_REST} AS gram FROM spoken
    WINDOW r AS (PARTITION BY row_id ORDER BY i)),
repetitive AS MATERIALIZED (
    SELECT DISTINCT row_id FROM (
        SELECT row_id FROM grams WHERE gram IS NOT NULL GROUP BY row_id, gram
        HAVING count(*) >= {CFG.repeat_ngram_min_count})),
featured AS MATERIALIZED (
    SELECT *, {LEVEL_CASE} AS readability_level,
        (rtrim(output, {BLANKS}) <> ''
         AND right(rtrim(output, {BLANKS}), 1) NOT IN ({lits(CFG.terminal_punct)}))::INT
            AS flag_truncated,
        (output_word_count < {CFG.min_output_words})::INT AS flag_too_short,
        (output_word_count < {CFG.empty_output_words})::INT AS flag_empty_ish,
        (row_id IN (SELECT row_id FROM repetitive))::INT AS flag_repetitive
    FROM scored)"""


def with_features(raw: str = MIXED) -> str:
    return f"WITH {cleaned(raw)}, {FEATURES}"


# ---- near duplicates -------------------------------------------------------


def tfidf(group: str, k: int = CFG.max_features) -> str:
    stop = lits(CFG.stop_words)
    return f"""
blocks AS (SELECT {group} AS g, count(*) AS n FROM featured WHERE {group} IS NOT NULL GROUP BY 1),
kept_words AS (
    SELECT row_id, {group} AS g,
           list_filter(string_split(instruction_clean, ' '),
                       lambda w: len(w) > 1 AND NOT list_contains([{stop}], w)) AS ws
    FROM featured WHERE {group} IS NOT NULL),
placed AS (
    SELECT row_id, g, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM kept_words),
all_terms AS (
    SELECT row_id, g, w AS term FROM placed
    UNION ALL
    SELECT a.row_id, a.g, a.w || ' ' || b.w
    FROM placed a JOIN placed b ON a.row_id = b.row_id AND b.i = a.i + 1),
tf AS (SELECT row_id, g, term, count(*) AS tf FROM all_terms GROUP BY ALL),
vocab AS (
    SELECT g, term, count(*) AS df FROM tf GROUP BY g, term HAVING count(*) >= {CFG.min_df}
    QUALIFY row_number() OVER (PARTITION BY g ORDER BY sum(tf) DESC, term) <= {k}),
raw_weights AS (
    SELECT row_id, tf.g, term, tf, tf * (ln((1 + n) / (1 + df)) + 1) AS x
    FROM tf JOIN vocab USING (g, term) JOIN blocks USING (g)),
weights AS MATERIALIZED (
    SELECT row_id, g, term, tf, x / sqrt(sum(x * x) OVER (PARTITION BY row_id)) AS w
    FROM raw_weights)"""


def near(group: str, rule: str = "nearest", k: int = CFG.max_features) -> str:
    partner = "" if rule == "nearest" else "AND b.row_id < a.row_id"
    return f"""{tfidf(group, k)},
sims AS (
    SELECT a.row_id, b.row_id AS other, round(sum(a.w * b.w), 9) AS similarity
    FROM weights a JOIN weights b ON a.g = b.g AND a.term = b.term AND a.row_id <> b.row_id {partner}
    GROUP BY a.row_id, b.row_id HAVING round(sum(a.w * b.w), 9) >= {CFG.duplicate_threshold}),
near AS MATERIALIZED (
    SELECT row_id, other AS duplicate_of, similarity FROM (
        SELECT * FROM sims
        QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY similarity DESC, other) = 1)
    WHERE other < row_id)"""


# ---- fact ------------------------------------------------------------------

FENCES = """
prose AS (SELECT row_id, cluster_id, round(flesch_score * 100) AS score FROM featured
          WHERE is_code_like = 0 AND flesch_score IS NOT NULL),
quartiles AS (
    SELECT cluster_id, count(*) AS n, quantile_cont(score, 0.25) AS q1,
           quantile_cont(score, 0.75) AS q3
    FROM prose WHERE cluster_id IS NOT NULL GROUP BY cluster_id),
fences AS (
    SELECT *, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM quartiles),
outliers AS MATERIALIZED (
    SELECT row_id FROM prose JOIN fences USING (cluster_id) WHERE score < lo OR score > hi)"""

NAMES_CASE = "CASE cluster_id " + " ".join(
    f"WHEN {k} THEN {lit(v)}" for k, v in CLUSTER_NAMES.items()
) + " END"

FACT_CTES = f"""{with_features()}, {near("cluster_id")}, {FENCES},
flagged AS (
    SELECT featured.*, {NAMES_CASE} AS cluster_label,
           (duplicate_of IS NOT NULL)::INT AS is_near_duplicate, duplicate_of,
           (row_id IN (SELECT row_id FROM outliers))::INT AS flag_readability_outlier
    FROM featured LEFT JOIN near USING (row_id)),
fact AS MATERIALIZED (
    SELECT *, greatest(100 - {CFG.flag_penalty} * n_flags, 0) AS adequacy_score
    FROM (SELECT *, {" + ".join(QUALITY_FLAGS)} AS n_flags FROM flagged))
"""


def on_fact(select: str) -> str:
    return FACT_CTES + select


def on_features(select: str, raw: str = MIXED) -> str:
    return with_features(raw) + select


TEXT_COLUMNS = """row_id, instruction, input_text, md5(output) AS output_md5"""

FEATURE_COLUMNS = """row_id, instruction_clean, has_input, instruction_word_count,
    output_word_count, sentence_count, words_per_sentence, is_code_like, flag_truncated,
    flag_too_short, flag_empty_ish, flag_repetitive"""

ANY_DUPE = "(is_exact_duplicate = 1 OR is_near_duplicate = 1)"
LOW = f"adequacy_score <= {CFG.low_adequacy_cutoff}"
CENTS = "round(flesch_score * 100)::BIGINT"
AVG_SCORE = half_up(f"sum({CENTS})", "count(flesch_score) * 100", 1, 1)


# ---- clusters --------------------------------------------------------------

CENTROIDS = """
WITH items AS (
    SELECT vec_id AS row_id, label, unnest(embedding)::DOUBLE AS raw,
           generate_subscripts(embedding, 1) AS i FROM embeddings),
coords AS MATERIALIZED (
    SELECT row_id, label, i, raw / sqrt(sum(raw * raw) OVER (PARTITION BY row_id)) AS x
    FROM items),
centroids AS MATERIALIZED (SELECT label AS cluster_id, i, avg(x) AS c FROM coords GROUP BY ALL),
gaps AS MATERIALIZED (
    SELECT row_id, cluster_id, sqrt(sum((x - c) * (x - c))) AS gap
    FROM coords JOIN centroids USING (i) GROUP BY ALL),
nearest AS MATERIALIZED (
    SELECT row_id, cluster_id, gap FROM gaps
    QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY gap, cluster_id) = 1)
"""


def lloyd(steps: int) -> str:
    """Plain Lloyd steps from the means of labels and of remainders, each step a query of its own."""
    ctes = """, starts AS (
        SELECT 'label' AS start, row_id, label AS place FROM coords GROUP BY ALL
        UNION ALL SELECT 'remainder', row_id, row_id % 6 FROM coords GROUP BY ALL),
    means1 AS (SELECT start, place, i, avg(x) AS c FROM starts JOIN coords USING (row_id) GROUP BY ALL)"""
    for n in range(1, steps + 1):
        ctes += f""",
    gaps{n} AS MATERIALIZED (SELECT start, row_id, place, sum((x - c) * (x - c)) AS gap
        FROM coords JOIN means{n} USING (i) GROUP BY ALL),
    near{n} AS MATERIALIZED (SELECT * FROM gaps{n}
        QUALIFY row_number() OVER (PARTITION BY start, row_id ORDER BY gap, place) = 1),
    means{n + 1} AS MATERIALIZED (SELECT start, place, i, coalesce(m, c) AS c FROM means{n} LEFT JOIN (
        SELECT start, place, i, avg(x) AS m FROM near{n} JOIN coords USING (row_id) GROUP BY ALL)
        USING (start, place, i))"""
    # Places are numbered from 0 in their order.
    found = " UNION ALL ".join(
        f"""SELECT start, {n}::BIGINT AS step, dense_rank() OVER (PARTITION BY start ORDER BY place) - 1 AS place,
            coalesce(n, 0) AS n, round(sum(cost) OVER (PARTITION BY start), 6) AS cost
        FROM (SELECT DISTINCT start, place FROM means{n}) LEFT JOIN (
            SELECT start, place, count(*) AS n, sum(gap) AS cost FROM near{n} GROUP BY ALL) USING (start, place)"""
        for n in range(1, steps + 1)
    )
    return CENTROIDS + ctes + found


# Ordered views: what names a row, and the order.
VIEW_ORDER = (
    ("v_cluster_composition", "cluster_label", "row_count DESC, cluster_label NULLS FIRST"),
    ("v_rule_vs_cluster", "prompt_type_rule", "row_count DESC, prompt_type_rule"),
    ("v_duplicate_rate", "cluster_label", "dupe_pct DESC, cluster_label NULLS FIRST"),
    ("v_length_quality", "quartile", "quartile"),
    ("v_cleaning_impact", "cluster_label, disposition", "cluster_label NULLS FIRST, disposition"),
)


def oracle_sql() -> dict[str, str]:
    sql = {
        "clean_corpus": f"WITH {cleaned(MIXED)} SELECT {TEXT_COLUMNS}, cluster_id FROM cleaned",
        "cleaning_counts": f"""WITH {cleaned(MIXED)}
            SELECT count(*) AS rows_read,
                   count(*) FILTER (instruction <> '' AND output <> '') AS rows_kept,
                   count(*) FILTER (instruction = '' OR output = '') AS rows_dropped
            FROM stripped""",
        "limit_rows": f"""SELECT order_key, instruction, input, md5(output) AS output_md5
            FROM ({MIXED}) ORDER BY order_key LIMIT 100""",
        "row_id": f"""WITH raw_rows AS ({MIXED})
            SELECT order_key, row_number() OVER (ORDER BY order_key) AS row_id FROM raw_rows
            WHERE trim(coalesce(instruction, ''), {BLANKS}) <> ''
              AND trim(coalesce(output, ''), {BLANKS}) <> ''""",
        "exact_duplicates": f"""WITH {cleaned(MIXED)}
            SELECT row_id, is_exact_duplicate FROM cleaned""",
        "exact_duplicate_count": f"""WITH {cleaned(MIXED)}
            SELECT sum(is_exact_duplicate)::BIGINT AS exact_duplicates FROM cleaned""",
        "text_features": on_features(f"SELECT {FEATURE_COLUMNS} FROM featured"),
        "conversation_features": on_features(
            f"SELECT {FEATURE_COLUMNS} FROM featured", CONVERSATIONS
        ),
        "page_features": on_features(f"SELECT {FEATURE_COLUMNS} FROM featured", PAGES),
        "flesch_readability": on_features(
            "SELECT row_id, flesch_score, readability_level FROM featured"
        ),
        "rule_category": on_features("SELECT row_id, prompt_type_rule FROM featured"),
        "rule_baseline": on_features(
            f"""SELECT prompt_type_rule, count(*) AS row_count,
                {pct("count(*)", "(sum(count(*)) OVER ())", 1)} AS pct,
                {pct("(sum(count(*) FILTER (prompt_type_rule = 'Other')) OVER ())",
                     "(sum(count(*)) OVER ())", 1)} AS other_pct
            FROM featured GROUP BY prompt_type_rule"""
        ),
        "tfidf_weights": on_features(
            f""", {tfidf("cluster_id")}
            SELECT g AS cluster_id, row_id, term, tf, round(w, 6) AS weight FROM weights"""
        ),
        "near_duplicates": on_features(
            f""", {near("cluster_id")}
            SELECT row_id, duplicate_of, round(similarity, 6) AS similarity FROM near"""
        ),
        "near_duplicates_small_vocabulary": on_features(
            f""", {near("cluster_id", k=SMALL_VOCABULARY.max_features)}
            SELECT row_id, duplicate_of, round(similarity, 6) AS similarity FROM near"""
        ),
        "near_duplicates_whole_text": on_features(
            f""", {near("cluster_id")}
            SELECT row_id, duplicate_of, round(similarity, 6) AS similarity FROM near""",
            DOCUMENTS_WHOLE,
        ),
        "near_duplicates_any_earlier": on_features(
            f""", {near("cluster_id", "any_earlier")}
            SELECT row_id, duplicate_of, round(similarity, 6) AS similarity FROM near"""
        ),
        "near_duplicates_by_rule": on_features(
            f""", {near("prompt_type_rule")}
            SELECT row_id, duplicate_of, round(similarity, 6) AS similarity FROM near"""
        ),
        "readability_fences": on_features(
            f""", {FENCES}
            SELECT cluster_id, n, q1 / 100 AS q1, q3 / 100 AS q3, lo / 100 AS lo, hi / 100 AS hi
            FROM fences"""
        ),
        "readability_outliers": on_features(
            f""", {FENCES}
            SELECT row_id, (row_id IN (SELECT row_id FROM outliers))::INT
                AS flag_readability_outlier FROM featured"""
        ),
        "adequacy": on_fact("SELECT row_id, n_flags, adequacy_score FROM fact"),
        "low_adequacy": on_fact(f"SELECT row_id, n_flags, adequacy_score FROM fact WHERE {LOW}"),
        "select_fact": on_fact(
            """SELECT row_id, instruction, input_text, output, has_input, instruction_word_count,
                output_word_count, sentence_count, words_per_sentence, prompt_type_rule, cluster_id,
                cluster_label, flesch_score, readability_level, is_code_like, is_exact_duplicate,
                is_near_duplicate, coalesce(duplicate_of, 0) AS duplicate_of, flag_truncated,
                flag_too_short, flag_empty_ish, flag_repetitive, flag_readability_outlier, n_flags,
                adequacy_score FROM fact"""
        ),
        "relabel_clusters": f"""WITH {cleaned(MIXED)}
            SELECT row_id, cluster_id, {NAMES_CASE} AS cluster_label FROM cleaned""",
        "cluster_sizes": f"""WITH {cleaned(MIXED)}
            SELECT cluster_id, {NAMES_CASE} AS cluster_label, count(*) AS row_count
            FROM cleaned GROUP BY cluster_id""",
        "flagged_per_cluster": on_fact(
            """SELECT cluster_id, count(*) AS row_count,
                sum(is_near_duplicate)::BIGINT AS flagged FROM fact GROUP BY cluster_id"""
        ),
        "length_quartile": on_features(
            """SELECT row_id, ntile(4) OVER (ORDER BY output_word_count, row_id) AS quartile
            FROM featured"""
        ),
        "duplicate_roots": on_fact(
            """, chain AS (
                WITH RECURSIVE walk(row_id, root) AS (
                    SELECT row_id, duplicate_of FROM fact WHERE duplicate_of IS NOT NULL
                    UNION ALL
                    SELECT w.row_id, f.duplicate_of FROM walk w JOIN fact f ON f.row_id = w.root
                    WHERE f.duplicate_of IS NOT NULL)
                SELECT row_id, min(root) AS root FROM walk GROUP BY row_id)
            SELECT row_id, root FROM chain"""
        ),
        "review_sample": on_fact(
            f"""SELECT row_id, instruction, md5(output) AS output_md5, n_flags, adequacy_score,
                {", ".join(QUALITY_FLAGS)}
            FROM fact WHERE {LOW}
            ORDER BY md5('{CFG.seed}:' || row_id), row_id LIMIT {CFG.review_rows}"""
        ),
        "sample_rows": f"""WITH {cleaned(MIXED)}
            SELECT row_id FROM cleaned ORDER BY md5('{CFG.seed}:' || row_id), row_id LIMIT 200""",
        "audit_report": on_fact(
            f"""SELECT count(*) AS total_rows,
                sum(is_exact_duplicate)::BIGINT AS exact_duplicates,
                sum(is_near_duplicate)::BIGINT AS near_duplicates,
                count(*) FILTER {ANY_DUPE} AS duplicate_rows_union,
                {pct(f"count(*) FILTER {ANY_DUPE}", "count(*)")} AS duplicate_pct,
                count(*) FILTER ({LOW}) AS low_adequacy_rows,
                {pct(f"count(*) FILTER ({LOW})", "count(*)")} AS low_adequacy_pct,
                {", ".join(f"sum({f})::BIGINT AS {f}" for f in QUALITY_FLAGS)},
                {avg("sum(adequacy_score)", "count(*)", 2)} AS mean_adequacy,
                count(*) FILTER ({ANY_DUPE} OR {LOW}) AS recommended_drop_rows,
                {pct(f"count(*) FILTER ({ANY_DUPE} OR {LOW})", "count(*)")}
                    AS recommended_drop_pct,
                count(*) FILTER (NOT ({ANY_DUPE} OR {LOW})) AS rows_remaining_after_clean,
                (SELECT string_agg(cluster_label || '=' || n, ';' ORDER BY cluster_label)
                 FROM (SELECT cluster_label, count(*) AS n FROM fact GROUP BY cluster_label))
                    AS cluster_sizes
            FROM fact"""
        ),
        "v_cluster_composition": on_fact(
            f"""SELECT cluster_label, count(*) AS row_count,
                {pct("count(*)", "(sum(count(*)) OVER ())")} AS pct_of_corpus,
                {avg("sum(instruction_word_count)", "count(*)")} AS avg_instruction_len,
                {avg("sum(output_word_count)", "count(*)")} AS avg_response_len,
                {AVG_SCORE} AS avg_readability,
                {avg("sum(adequacy_score)", "count(*)")} AS avg_adequacy
            FROM fact GROUP BY cluster_label"""
        ),
        "v_rule_vs_cluster": on_fact(
            f"""SELECT prompt_type_rule, count(*) AS row_count,
                {pct("count(*)", "(sum(count(*)) OVER ())")} AS pct_of_corpus,
                count(DISTINCT cluster_label) AS distinct_clusters_spanned
            FROM fact GROUP BY prompt_type_rule"""
        ),
        "v_duplicate_rate": on_fact(
            f"""SELECT cluster_label, count(*) AS total_rows,
                sum(is_exact_duplicate)::BIGINT AS exact_dupes,
                sum(is_near_duplicate)::BIGINT AS near_dupes,
                count(*) FILTER {ANY_DUPE} AS any_dupe,
                {pct(f"count(*) FILTER {ANY_DUPE}", "count(*)")} AS dupe_pct
            FROM fact GROUP BY cluster_label"""
        ),
        "v_duplicate_pairs": on_fact(
            """SELECT d.row_id AS flagged_row, left(d.instruction, 90) AS flagged_instruction,
                k.row_id AS kept_row, left(k.instruction, 90) AS kept_instruction, d.cluster_label
            FROM fact d JOIN fact k ON d.duplicate_of = k.row_id WHERE d.is_near_duplicate = 1"""
        ),
        "v_worst_by_cluster": on_fact(
            f"""SELECT * FROM (
                SELECT row_id, cluster_label, adequacy_score, n_flags, output_word_count,
                    left(instruction, 80) AS instruction_preview,
                    left(output, 120) AS output_preview,
                    rank() OVER (PARTITION BY cluster_id
                                 ORDER BY adequacy_score, output_word_count) AS rk
                FROM fact) WHERE rk <= {CFG.worst_per_cluster}"""
        ),
        "v_flag_prevalence": on_fact(
            " UNION ALL ".join(
                f"""SELECT {lit(f.removeprefix("flag_"))} AS flag_name, sum({f})::BIGINT AS n,
                {pct(f"sum({f})", "count(*)")} AS pct FROM fact"""
                for f in QUALITY_FLAGS
            )
        ),
        "v_length_quality": on_fact(
            f"""SELECT quartile, count(*) AS n_rows, min(output_word_count) AS min_words,
                max(output_word_count) AS max_words,
                {avg("sum(adequacy_score)", "count(*)")} AS avg_adequacy,
                {AVG_SCORE} AS avg_readability
            FROM (SELECT *, ntile(4) OVER (ORDER BY output_word_count, row_id) AS quartile
                  FROM fact) GROUP BY quartile"""
        ),
        "v_deviation_from_cluster": on_fact(
            f"""SELECT row_id, cluster_label, output_word_count,
                {avg("total", "n")} AS cluster_avg_len,
                {avg("(output_word_count * n - total)", "n")} AS deviation,
                coalesce({half_up("(rk - 1)", "(n - 1)", 1, 3)}, 0.0) AS pct_rank_in_cluster,
                adequacy_score
            FROM (SELECT *, count(*) OVER c AS n, sum(output_word_count) OVER c AS total,
                      rank() OVER (PARTITION BY cluster_id ORDER BY output_word_count) AS rk
                  FROM fact WINDOW c AS (PARTITION BY cluster_id))"""
        ),
        "v_cleaning_impact": on_fact(
            f"""SELECT cluster_label, disposition, count(*) AS n_rows,
                {pct("count(*)", "(sum(count(*)) OVER (PARTITION BY cluster_label))")}
                    AS pct_of_cluster
            FROM (SELECT *, CASE WHEN {ANY_DUPE} THEN 'drop_duplicate'
                                 WHEN {LOW} THEN 'drop_low_quality' ELSE 'keep' END AS disposition
                  FROM fact) GROUP BY cluster_label, disposition"""
        ),
        "assign_clusters": CENTROIDS
        + "SELECT row_id, cluster_id, round(gap, 6) AS distance FROM nearest",
        "silhouette": CENTROIDS
        + """, sizes AS (SELECT cluster_id, count(*) AS n FROM nearest GROUP BY 1),
            member AS (SELECT row_id, cluster_id, i, x FROM coords JOIN nearest USING (row_id)),
            apart AS (SELECT a.row_id, a.cluster_id AS own, b.cluster_id AS other,
                          1 - sum(a.x * b.x) AS d, b.row_id AS other_row
                      FROM member a JOIN member b USING (i) GROUP BY ALL),
            means AS (SELECT row_id, own, other,
                          sum(d) FILTER (other_row <> row_id)
                              / (any_value(n) - (own = other)::INT) AS m
                      FROM apart JOIN sizes ON sizes.cluster_id = other
                      GROUP BY row_id, own, other),
            ab AS (SELECT row_id, max(m) FILTER (own = other) AS a,
                          min(m) FILTER (own <> other) AS b FROM means GROUP BY row_id)
            SELECT round(avg((b - a) / greatest(a, b)), 6) AS silhouette FROM ab""",
        "cluster_exemplars": CENTROIDS
        + f"""SELECT cluster_id, position, left(split_part(text, chr(10), 1),
                {CFG.exemplar_chars}) AS exemplar
            FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY gap, row_id)
                      AS position FROM nearest JOIN documents ON doc_id = row_id)
            WHERE position <= {CFG.exemplars}""",
    }
    near_columns = "SELECT row_id, duplicate_of, round(similarity, 6) AS similarity FROM near"
    sql |= {
        "exact_duplicates_whole_text": f"""WITH {cleaned(DOCUMENTS_WHOLE)}
            SELECT row_id, is_exact_duplicate FROM cleaned""",
        "exact_duplicate_count_whole_text": f"""WITH {cleaned(DOCUMENTS_WHOLE)}
            SELECT sum(is_exact_duplicate)::BIGINT AS exact_duplicates FROM cleaned""",
        "tfidf_weights_whole_text": on_features(
            f""", {tfidf("cluster_id")}
            SELECT g AS cluster_id, row_id, term, tf, round(w, 6) AS weight FROM weights""",
            DOCUMENTS_WHOLE,
        ),
        "near_duplicates_small_vocabulary_whole_text": on_features(
            f", {near('cluster_id', k=SMALL_VOCABULARY.max_features)} {near_columns}", DOCUMENTS_WHOLE
        ),
        "near_duplicates_any_earlier_whole_text": on_features(
            f", {near('cluster_id', 'any_earlier')} {near_columns}", DOCUMENTS_WHOLE
        ),
        "near_duplicates_by_rule_whole_text": on_features(
            f", {near('prompt_type_rule')} {near_columns}", DOCUMENTS_WHOLE
        ),
        "cluster_exemplars_whole_text": CENTROIDS
        + f"""SELECT cluster_id, position, left(text, {CFG.exemplar_chars}) AS exemplar
            FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY gap, row_id)
                      AS position FROM nearest JOIN documents ON doc_id = row_id)
            WHERE position <= {CFG.exemplars}""",
        "cluster_corpus_whole_text": on_features(
            "SELECT row_id, instruction_clean = '' AS is_unassigned FROM featured", DOCUMENTS_WHOLE
        ),
    }
    views = [v for v in sql if v.startswith("v_")]
    selects = {v: sql[v].removeprefix(FACT_CTES) for v in views}
    sql |= {
        "corpus_with_text_column": sql["clean_corpus"],
        "saved_stage": sql["text_features"],
        "loaded_fact": sql["select_fact"],
        "audit_json": sql["audit_report"],
        "sample_csv": on_fact(
            f"""SELECT row_id, instruction, md5(output) AS output_md5, adequacy_score
            FROM fact WHERE row_id <= {CFG.sample_csv_rows}"""
        ),
        "review_csv": on_fact(
            f"""SELECT row_id, md5(output) AS output_md5, n_flags, adequacy_score,
                {", ".join(QUALITY_FLAGS)}
            FROM fact WHERE {LOW}
            ORDER BY md5('{CFG.seed}:' || row_id), row_id LIMIT {CFG.review_rows}"""
        ),
        "exported_views": on_fact(
            " UNION ALL ".join(
                f"SELECT {lit(v)} AS view, 'ok' AS status, count(*) AS row_count FROM ({s})"
                for v, s in selects.items()
            )
        ),
        "ordered_views": on_fact(
            " UNION ALL ".join(
                f"""SELECT {lit(v)} AS view, concat_ws('/', {key}) AS row_name,
                    row_number() OVER (ORDER BY {order}) AS place FROM ({selects[v]})"""
                for v, key, order in VIEW_ORDER
            )
        ),
        # K-Means is random, but what its results must satisfy is not.
        "cluster_corpus": on_features(
            "SELECT row_id, instruction_clean = '' AS is_unassigned FROM featured"
        ),
        "fit_kmeans": CENTROIDS
        + """SELECT vec_id AS row_id, true AS at_nearest, 7::BIGINT AS n_clusters,
                (SELECT count(DISTINCT row_id) FROM coords) AS rows_fitted,
                (SELECT round(sum(x * x), 6) FROM coords) AS squares FROM embeddings""",
        "sweep_k": CENTROIDS
        + f"""SELECT k, true AS score_in_range, 1 AS n_best,
                (SELECT count(*) FROM embeddings) AS rows_assigned,
                (SELECT round(sum(x * x), 6) FROM coords) AS squares
            FROM range({CFG.k_min}, {CFG.k_max + 1}) AS swept(k)""",
        "kmeans_steps": lloyd(STEPS),
        "model_vectors": f"""WITH {cleaned(MIXED)}, raw AS (
                SELECT row_id, length(instruction)::DOUBLE AS a,
                       (length(instruction) - length(replace(instruction, 'e', '')) + 1)::DOUBLE AS b FROM cleaned)
            SELECT row_id, round(a / sqrt(a * a + b * b), 6) AS x0, round(b / sqrt(a * a + b * b), 6) AS x1
            FROM raw""",
        "loaded_corpus": f"""SELECT order_key, instruction, input, md5(output) AS output_md5 FROM ({MIXED})""",
        "quantiles_by_sketch": on_features(
            f"""SELECT cluster_id, share, n, min(output_word_count) AS words FROM (
                SELECT cluster_id, output_word_count, count(*) OVER c AS n,
                       row_number() OVER (c ORDER BY output_word_count) AS place
                FROM featured WINDOW c AS (PARTITION BY cluster_id))
            CROSS JOIN (SELECT unnest({SHARES}) AS share)
            WHERE place >= greatest(ceil(round(share * n, 6)), 1) GROUP BY ALL"""
        ),
        "sketch_bounds": on_features(
            f"""SELECT cluster_id, unnest({SHARES}) AS share, count(*) AS n, true AS holds_rank
            FROM featured GROUP BY cluster_id"""
        ),
        "cleaning_counts_observed": sql["cleaning_counts"],
        "missing_columns": f"""WITH {cleaned(MIXED)}
            SELECT (SELECT count(*) FROM cleaned) AS row_count, unnest([
                'cluster_label', 'is_near_duplicate', 'duplicate_of', 'flag_readability_outlier',
                'n_flags', 'adequacy_score']) AS missing""",
        "default_labels": f"""WITH {cleaned(MIXED)}
            SELECT row_id, cluster_id, 'cluster_' || cluster_id AS cluster_label FROM cleaned""",
        "cluster_json": CENTROIDS
        + f"""SELECT cluster_id, count(*) AS n, least(count(*), {CFG.exemplars})::INT AS shown,
                left(split_part(arg_min(text, (gap, row_id)), chr(10), 1), {CFG.exemplar_chars}) AS nearest
            FROM nearest JOIN documents ON doc_id = row_id GROUP BY cluster_id""",
        "resumed_audit": sql["select_fact"],
        "renamed_then_reflagged": sql["select_fact"].replace("prompt_type_rule, cluster_id,", "prompt_type_rule,"),
        "incremental_fact": sql["select_fact"],
        "streamed_duplicates": sql["exact_duplicates"],
        "fact_by_cluster": sql["select_fact"],
        **{f"stored_{v}": sql[v] for v in views},
    }
    return sql
