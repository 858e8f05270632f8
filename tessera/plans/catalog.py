"""Queries over the driver's tables and the SQL that each must equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rules, scoring, text
from ..operators import conversation, convert, dedup, metrics, sample, similarity
from ..operators.keywords import ranked_terms
from . import clean as cleaning
from .config import Cases, Cleaning, Scoring

QUERIES: dict = {}
SQL: dict = {}

#: Vocabularies that the driver's tables can match.
CLEAN = Cleaning(ad_keywords=("subscribe", "click here"))
CASES = Cases(risk_terms=("terror", "nicht", "toxic"), hints=("tion", "keit"), stopwords=("the", "and", "les", "der"))
SCORE = Scoring(sections=("the", "in", "on", "tion"), positive=("with", "und"), negative=("that", "les"), prompt_risk=("error", "keit"), diagnosis="the", safeguards=("in",))
KEYWORDS = ("tion", "the", "keit")
#: White space as Java's (?U)\s has it, for RE2.
_S = r"[\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_CONTACT = "(?i)" + "|".join(CLEAN.contact_patterns)


def _squeeze(c: str) -> str:
    return f"regexp_replace({c}, '{_S}', '', 'g')"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{_S}+|{_S}+$', '', 'g')"


def _collapse(c: str) -> str:
    return _strip(f"regexp_replace({c}, '{_S}+', ' ', 'g')")


def _has(c: str, terms) -> str:
    return "(" + " OR ".join(f"contains({c}, '{t}')" for t in terms) + ")"


_KEY = f"sha256(lower({_squeeze('text')}))"
_PAIRS = """
SELECT conv_id, turn, text AS question, nt AS answer FROM (
  SELECT *, lead(role) OVER w AS nr, lead(text) OVER w AS nt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)
) WHERE role = 'user' AND nr = 'assistant'"""


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.pairs(table(spark, sf_dir, "conversations"))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(conv_id, conversations): one row a chat, turns in order."""
    t = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", F.col("role").alias("from"), F.col("text").alias("value")))).alias("t"))
    return t.select("conv_id", F.transform("t", lambda m: F.struct(m["from"].alias("from"), m["value"].alias("value"))).alias("conversations"))


def _reasons(docs: DataFrame) -> DataFrame:
    n = rules.answer_length_reason(F.col("text"), CLEAN)
    d = docs.select("doc_id", F.coalesce(n, F.when(rules.is_ad(F.col("text"), CLEAN), F.lit("ad_or_contact"))).alias("reason"), F.sha2(text.compact(F.col("text")), 256).alias("k"))
    d = dedup.mark_repeats(d, F.when(F.col("reason").isNull(), F.col("k")), [F.col("doc_id")])
    return d.select("doc_id", F.when(F.col("is_repeat"), "duplicate").otherwise(F.coalesce("reason", F.lit("kept"))).alias("reason"))


_REASON_SQL = f"""
WITH a AS (SELECT doc_id, text, length({_squeeze('text')}) AS n, {_KEY} AS k FROM documents
), b AS (SELECT doc_id, k, CASE WHEN n IS NULL OR n = 0 THEN 'empty_field' WHEN n < 10 THEN 'too_short' WHEN n > 8192 THEN 'too_long'
  WHEN {_has('text', CLEAN.ad_keywords)} OR regexp_matches(text, '{_CONTACT}') THEN 'ad_or_contact' END AS r FROM a
), c AS (SELECT doc_id, CASE WHEN r IS NULL AND row_number() OVER (PARTITION BY r IS NULL, k ORDER BY doc_id) > 1 THEN 'duplicate' ELSE coalesce(r, 'kept') END AS reason FROM b)
"""


@query(_REASON_SQL + "SELECT reason, count(*) AS n FROM c GROUP BY reason")
def clean_reject_reasons(spark, sf_dir):
    """One reason a document, in order; repeats among those that nothing else rejects."""
    return metrics.counts_by(_reasons(table(spark, sf_dir, "documents")), "reason")


@query(_REASON_SQL + "SELECT doc_id FROM c WHERE reason = 'kept'")
def clean_kept_documents(spark, sf_dir):
    return _reasons(table(spark, sf_dir, "documents")).where("reason = 'kept'").select("doc_id")


@query(f"SELECT doc_id, k AS dedup_key FROM (SELECT doc_id, {_KEY} AS k FROM documents) QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id) = 1")
def exact_dedup_keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.compact(F.col("text")), 256).alias("dedup_key"))
    return dedup.keep_first(d, F.col("dedup_key"), [F.col("doc_id")])


@query(f"SELECT doc_id FROM documents WHERE {_has('text', CLEAN.ad_keywords)} OR regexp_matches(text, '{_CONTACT}')")
def contact_filter(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(rules.is_ad(F.col("text"), CLEAN)).select("doc_id")


@query(f"SELECT lang, count(n) AS n, min(n) AS min_chars, max(n) AS max_chars, round(avg(n), 2) AS avg_chars FROM (SELECT lang, length({_squeeze('text')}) AS n FROM documents) GROUP BY lang")
def content_length_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("lang", text.content_chars(F.col("text")).alias("len"))
    n = F.col("len")
    return d.groupBy("lang").agg(F.count(n).alias("n"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.round(F.avg(n), 2).alias("avg_chars"))


_TIDY = "coalesce(html, '')"
for _p, _r in ((r"<[^>]+>", " "), (r"[\x{feff}\x{200b}\x7f\x0e-\x1f\x0b\x0c\x00-\x08]", ""), (r"[ \t\r]+", " "), (r"[\x{85}\x{2028}\x{2029}]", "\n"), (_S.replace(r"\n", "") + "*\\n" + _S.replace(r"\n", "") + "*", "\n"), (r"\n{3,}", "\n\n")):
    _TIDY = f"regexp_replace({_TIDY}, '{_p}', '{_r}', 'g')"


@query(f"SELECT page_id, {_strip(_TIDY)} AS text FROM pages")
def html_strip(spark, sf_dir):
    """Tags, control characters and spaces of every page."""
    return table(spark, sf_dir, "pages").select("page_id", text.strip_tags(F.col("html")).alias("text"))


@query()
def html_normalize(spark, sf_dir):
    """The full normalisation with entities and NFKC."""
    return table(spark, sf_dir, "pages").select("page_id", text.normalize(F.col("html")).alias("text"))


@query(f"SELECT doc_id, {_collapse('text')} AS text FROM documents")
def collapse_spaces(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.collapse(F.col("text")).alias("text"))


_REPAIR_SQL = """
WITH k AS (SELECT conv_id, turn, CASE WHEN role IN ('病人', '患者', 'user', 'human') THEN 'human' WHEN role IN ('客服', '医生', 'doctor', 'assistant', 'gpt') THEN 'gpt' END AS role, text FROM conversations
), i AS (SELECT *, CASE WHEN lag(role) OVER (PARTITION BY conv_id ORDER BY turn) = role THEN 0 ELSE 1 END AS opens FROM k WHERE role IS NOT NULL AND text <> ''
), s AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM i
), j AS (SELECT conv_id, island, role, string_agg(text, chr(10) ORDER BY turn) AS text FROM s GROUP BY ALL
), b AS (SELECT *, min(island) FILTER (WHERE role = 'human') OVER w AS low, max(island) FILTER (WHERE role = 'gpt') OVER w AS high FROM j WINDOW w AS (PARTITION BY conv_id)
), r AS (SELECT conv_id, (island - low)::INTEGER AS turn, role, text FROM b WHERE high > low AND island BETWEEN low AND high)
"""


@query(_REPAIR_SQL + "SELECT * FROM r")
def conv_repair(spark, sf_dir):
    return conversation.repair_turns(table(spark, sf_dir, "conversations"))


@query(_REPAIR_SQL + ", n AS (SELECT c.conv_id, c.n AS a, coalesce(r.n, 0) AS b FROM (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) c LEFT JOIN (SELECT conv_id, count(*) AS n FROM r GROUP BY 1) r USING (conv_id)) SELECT count(*) AS chats, count(*) FILTER (WHERE a <> b) AS repaired, count(*) FILTER (WHERE b = 0) AS failed FROM n")
def conv_repair_report(spark, sf_dir):
    return conversation.repair_report(table(spark, sf_dir, "conversations"))


@query(_REPAIR_SQL.replace("text FROM conversations", f"{_strip('text')} AS text FROM conversations") + ", c AS (SELECT conv_id, count(*) AS n, string_agg(role || ':' || text, chr(10) ORDER BY turn) AS chat FROM r GROUP BY 1) SELECT conv_id, n AS turns, chat FROM c")
def conv_repair_arrays(spark, sf_dir):
    """The same repair, one row a chat, with full normalisation of the texts."""
    fixed = conversation.repair(chats(spark, sf_dir)).where("messages IS NOT NULL")
    return fixed.select("conv_id", F.size("messages").cast("long").alias("turns"), F.array_join(F.transform("messages", lambda m: F.concat_ws(":", m["from"], m["value"])), "\n").alias("chat"))


@query(_PAIRS)
def conv_pairs(spark, sf_dir):
    return pairs(spark, sf_dir)


@query("SELECT conv_id, max_by(text, turn) AS system_prompt FROM conversations WHERE role = 'system' GROUP BY conv_id")
def conv_system(spark, sf_dir):
    return conversation.system_turns(table(spark, sf_dir, "conversations"))


@query("SELECT conv_id, bool_and(role IN ('system', 'user', 'assistant') AND text IS NOT NULL) AS valid FROM conversations GROUP BY conv_id")
def chat_validate(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", rules.valid_chat(F.col("conversations"), ("system", "user", "assistant")).alias("valid"))


@query(f"SELECT conv_id, sha256(string_agg(role || ':' || lower({_squeeze('text')}), chr(10) ORDER BY turn)) AS dedup_key FROM conversations GROUP BY conv_id")
def conv_dedup_key(spark, sf_dir):
    return chats(spark, sf_dir).select("conv_id", dedup.chat_key(F.col("conversations")).alias("dedup_key"))


@query(f"""
WITH k AS (SELECT conv_id, turn, role, text FROM conversations WHERE role IN ('user', 'assistant')
), i AS (SELECT *, CASE WHEN role = 'user' AND coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), '') <> 'user' THEN 1 ELSE 0 END AS opens FROM k
), s AS (SELECT *, sum(opens) OVER (PARTITION BY conv_id ORDER BY turn) AS pair FROM i
), p AS (SELECT conv_id, pair, string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE role = 'user') AS user_text, min_by(text, turn) FILTER (WHERE role = 'assistant') AS assistant_text FROM s WHERE pair > 0 GROUP BY ALL)
SELECT conv_id, (row_number() OVER (PARTITION BY conv_id ORDER BY pair) - 1)::INTEGER AS pos, user_text, assistant_text FROM p WHERE assistant_text IS NOT NULL
""")
def conv_history(spark, sf_dir):
    """User and assistant pairs as a trainer sees them."""
    h = chats(spark, sf_dir).select("conv_id", F.posexplode(conversation.history(F.col("conversations"))).alias("pos", "p"))
    return h.select("conv_id", "pos", F.col("p.user").alias("user_text"), F.col("p.assistant").alias("assistant_text"))


@query("""
WITH f AS (SELECT *, min(turn) FILTER (WHERE role = 'user') OVER (PARTITION BY conv_id) AS low FROM conversations
), k AS (SELECT conv_id, text, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM f WHERE turn >= low
), g AS (SELECT conv_id FROM k GROUP BY conv_id HAVING max(n) % 2 = 0 AND bool_and(CASE WHEN i % 2 = 0 THEN role = 'user' ELSE role = 'assistant' END))
SELECT conv_id, (i // 2)::INTEGER AS turn, text AS prompt FROM k WHERE i % 2 = 0 AND conv_id IN (SELECT conv_id FROM g)
""")
def rl_prompts(spark, sf_dir):
    return conversation.rl_prompts(chats(spark, sf_dir)).select("conv_id", "turn", "prompt")


@query(f"WITH p AS ({_PAIRS}) SELECT conv_id, turn, {_strip('question')} AS prompt, {_strip('answer')} AS reply FROM p WHERE {_strip('question')} <> '' AND {_strip('answer')} <> ''")
def single_to_chat(spark, sf_dir):
    """Pairs through the single-turn format to the chat format."""
    d = pairs(spark, sf_dir).select("conv_id", "turn", text.plain(F.col("question")).alias("instruction"), F.lit("").alias("input"), text.plain(F.col("answer")).alias("output"))
    c = d.where("instruction <> '' AND output <> ''").select("conv_id", "turn", convert.chat(("human", F.col("instruction")), ("gpt", F.col("output"))).alias("c"))
    return c.select("conv_id", "turn", F.col("c")[0]["value"].alias("prompt"), F.col("c")[1]["value"].alias("reply"))


def _keywords_sql(src: str) -> str:
    stop = ", ".join(f"'{s}'" for s in CASES.stopwords)
    hints = " UNION ALL ".join(f"SELECT id, {10**9 + k} AS i, '{h}' AS x FROM src WHERE contains(txt, '{h}')" for k, h in enumerate(dict.fromkeys(CASES.hints + CASES.risk_terms)))
    return rf"""
WITH src AS ({src}), pieces AS (SELECT id, generate_subscripts(l, 1) AS i, unnest(l) AS x FROM (
  SELECT id, string_split_regex(txt, '[\t\n\x0b\f\r\x1c-\x1f \x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}},.;:，。；：、（）()\[\]【】<>《》/\\]+') AS l FROM src)
), good AS (SELECT * FROM pieces WHERE length(x) BETWEEN 2 AND 16 AND NOT regexp_full_match(x, '\p{{Nd}}+') AND x NOT IN ({stop})
), terms AS (SELECT * FROM good UNION ALL SELECT h.* FROM ({hints}) h ANTI JOIN good g ON g.id = h.id AND g.x = h.x
), ranked AS (SELECT id, x, row_number() OVER (PARTITION BY id ORDER BY count(*) DESC, length(x), min(i)) AS r FROM terms GROUP BY id, x)
SELECT s.id, coalesce(string_agg(x, '|' ORDER BY r), '') AS keywords FROM src s LEFT JOIN ranked k ON k.id = s.id AND r <= {CASES.keywords} GROUP BY s.id
"""


@query(_keywords_sql("SELECT doc_id AS id, coalesce(text, '') AS txt FROM documents"))
def keywords_top8(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.array_join(ranked_terms(F.col("text"), CASES), "|").alias("keywords"))


def _cases(spark, sf_dir):
    d = pairs(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("row"), F.col("question").alias("instruction"), F.lit("").alias("input"), F.col("answer").alias("output"))
    return convert.complex_cases(d, F.col("row"), CASES, SCORE)


_CASE_SRC = f"SELECT conv_id * 1000 + turn AS rid, {_collapse('question')} AS p, {_collapse('answer')} AS a FROM ({_PAIRS})"
_HIGH = "CASE WHEN " + _has("lower(p || chr(10) || a)", CASES.risk_terms) + " THEN 'high' ELSE 'normal' END"


@query(f"WITH q AS ({_CASE_SRC}), k AS ({_keywords_sql('SELECT rid AS id, a AS txt FROM q')}) SELECT 'case-' || rid AS id, p AS prompt, a AS reference_answer, keywords, {_HIGH} AS risk_level FROM q JOIN k ON k.id = rid WHERE p <> '' AND a <> '' AND keywords <> ''")
def complex_cases(spark, sf_dir):
    return _cases(spark, sf_dir).select("id", "prompt", "reference_answer", F.array_join("answer_keywords", "|").alias("keywords"), "risk_level")


@query(f"WITH q AS ({_CASE_SRC}) SELECT round(avg(({_HIGH} = 'high')::INTEGER), 4) AS high_risk_ratio FROM q WHERE p <> '' AND a <> ''")
def high_risk_ratio(spark, sf_dir):
    d = pairs(spark, sf_dir).select(text.collapse(F.col("question")).alias("p"), text.collapse(F.col("answer")).alias("a")).where("p <> '' AND a <> ''")
    return metrics.share(d, rules.is_high_risk(F.col("p"), F.col("a"), CASES), "high_risk_ratio")


@query(f"WITH q AS ({_CASE_SRC}) SELECT rid, 'Answer in four parts:' || chr(10) || p AS prompt, p AS original_prompt FROM q")
def format_prompt(spark, sf_dir):
    """Prefixing twice equals prefixing once."""
    d = pairs(spark, sf_dir).select((F.col("conv_id") * 1000 + F.col("turn")).alias("rid"), text.collapse(F.col("question")).alias("prompt"))
    lead = "Answer in four parts:\n"
    return convert.add_format_prompt(convert.add_format_prompt(d, lead), lead).select("rid", "prompt", "original_prompt")


_PAIR_TEXT = f"SELECT conv_id, turn, {_collapse('question')} AS p, {_collapse('answer')} AS r, question, answer FROM ({_PAIRS})"
_FORMAT = "(" + " + ".join(f"contains(r, '{s}')::INTEGER" for s in SCORE.sections) + f") / {len(SCORE.sections)}.0::DOUBLE"
_COVER = "(" + " + ".join(f"contains(lower(r), '{s}')::INTEGER" for s in KEYWORDS) + f") / {len(KEYWORDS)}.0::DOUBLE"
_SAFE = f"CASE WHEN {_has('r', SCORE.negative)} THEN 0.0 WHEN {_has('p', SCORE.prompt_risk)} AND NOT {_has('r', SCORE.positive)} THEN 0.0 ELSE 1.0 END::DOUBLE"


def _scored(spark, sf_dir):
    d = pairs(spark, sf_dir).select("conv_id", "turn", F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("question").alias("prompt"), F.col("answer").alias("response"), F.array(*map(F.lit, SCORE.sections)).alias("required_sections"), F.array(*map(F.lit, KEYWORDS)).alias("answer_keywords"), F.lit("normal").alias("risk_level"))
    return metrics.score_responses(d, cfg=SCORE)


@query(f"WITH q AS ({_PAIR_TEXT}) SELECT conv_id, turn, round({_FORMAT}, 6) AS format_score, {_FORMAT} >= 1 AS format_pass, {_SAFE} AS safety_coverage, round({_COVER}, 6) AS keyword_coverage FROM q")
def response_scores(spark, sf_dir):
    return _scored(spark, sf_dir).select("conv_id", "turn", F.round("format_score", 6).alias("format_score"), "format_pass", "safety_coverage", F.round("keyword_coverage", 6).alias("keyword_coverage"))


@query(f"""WITH q AS ({_PAIR_TEXT}), s AS (SELECT *, CASE WHEN turn % 3 = 0 THEN ['the', 'und'] ELSE ['{"', '".join(SCORE.sections)}'] END AS names FROM q)
SELECT conv_id, turn, round(len(list_filter(names, lambda n: contains(r, n))) / len(names), 6) AS format_score FROM s""")
def default_sections(spark, sf_dir):
    """Rows without section names, null or none, are held to the default ones."""
    own = F.when(F.col("turn") % 3 == 0, F.array(F.lit("the"), F.lit("und"))).when(F.col("turn") % 3 == 1, F.array().cast("array<string>"))
    d = pairs(spark, sf_dir).select("conv_id", "turn", F.col("question").alias("prompt"), F.col("answer").alias("response"), own.alias("required_sections"), F.array(*map(F.lit, KEYWORDS)).alias("answer_keywords"), F.lit("normal").alias("risk_level"))
    return metrics.score_responses(d, cfg=SCORE).select("conv_id", "turn", F.round("format_score", 6).alias("format_score"))


@query(f"WITH q AS ({_PAIR_TEXT}) SELECT count(*) AS total, round(avg(({_FORMAT} >= 1)::INTEGER), 6) AS format_accuracy, round(avg({_FORMAT}), 6) AS avg_format_score, round(avg({_SAFE}), 6) AS safety_coverage, round(avg({_COVER}), 6) AS keyword_coverage, 0::BIGINT AS high_risk_count FROM q")
def response_report(spark, sf_dir):
    r = metrics.response_report(_scored(spark, sf_dir))
    return r.select("total", *(F.round(c, 6).alias(c) for c in ("format_accuracy", "avg_format_score", "safety_coverage", "keyword_coverage")), "high_risk_count")


@query(f"WITH q AS ({_PAIR_TEXT}) SELECT conv_id || '-' || turn AS id, substr(question, 1, 120) AS prompt, substr(answer, 1, 300) AS response FROM q WHERE {_FORMAT} < 1")
def bad_cases(spark, sf_dir):
    return metrics.bad_cases(_scored(spark, sf_dir)).drop("missing_sections")


_F1_SQL = f"""
q AS ({_PAIR_TEXT}), c AS (
  SELECT conv_id, turn, ch, sum((side = 0)::INTEGER) AS a, sum((side = 1)::INTEGER) AS b FROM (
    SELECT conv_id, turn, 0 AS side, unnest(string_split({_squeeze('question')}, '')) AS ch FROM q UNION ALL
    SELECT conv_id, turn, 1 AS side, unnest(string_split({_squeeze('answer')}, '')) AS ch FROM q) WHERE ch <> '' GROUP BY ALL
), f AS (SELECT conv_id, turn, CASE WHEN sum(least(a, b)) = 0 THEN 0.0 ELSE 2.0 * sum(least(a, b)) / (sum(a) + sum(b)) END::DOUBLE AS f1 FROM c GROUP BY ALL)"""


@query(f"WITH {_F1_SQL} SELECT q.conv_id, q.turn, round(coalesce(f1, 0.0), 6) AS char_f1 FROM q LEFT JOIN f USING (conv_id, turn)")
def char_f1(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", F.round(scoring.char_f1(F.col("question"), F.col("answer")), 6).alias("char_f1"))


_GOOD = _has("r", SCORE.positive)
_SAFETY = "greatest(0.0, least(1.0, 1.0" + "".join(f" - 0.25 * contains(r, '{t}')::INTEGER" for t in SCORE.negative) + f" - CASE WHEN {_has('p', SCORE.prompt_risk)} AND NOT {_GOOD} THEN 0.35 ELSE 0 END + CASE WHEN {_GOOD} THEN 0.1 ELSE 0 END - CASE WHEN (contains(p, 'the') OR contains(r, 'the')) AND NOT contains(r, 'in') THEN 0.1 ELSE 0 END))::DOUBLE"


@query(f"WITH {_F1_SQL} SELECT q.conv_id, q.turn, round(0.3 * {_FORMAT} + 0.5 * (0.7 * {_COVER} + 0.3 * coalesce(f1, 0.0)) + 0.2 * {_SAFETY}, 6) AS reward FROM q LEFT JOIN f USING (conv_id, turn)")
def reward_total(spark, sf_dir):
    q, a = F.col("question"), F.col("answer")
    words = F.array(*map(F.lit, KEYWORDS))
    total = scoring.total_reward(scoring.format_reward(a, SCORE.sections), scoring.accuracy_reward(a, q, words), scoring.safety_reward(q, a, F.lit("normal"), SCORE))
    return pairs(spark, sf_dir).select("conv_id", "turn", F.round(total, 6).alias("reward"))


_PPL = "count(*) FILTER (WHERE l IS NOT NULL AND k > 0) AS rows, sum(k) FILTER (WHERE l IS NOT NULL AND k > 0)::BIGINT AS tokens, round(sum(l * k) FILTER (WHERE l IS NOT NULL AND k > 0) / sum(k) FILTER (WHERE l IS NOT NULL AND k > 0), 6) AS nll, round(exp(sum(l * k) FILTER (WHERE l IS NOT NULL AND k > 0) / sum(k) FILTER (WHERE l IS NOT NULL AND k > 0)), 6) AS ppl"


@query(f"SELECT event_type, {_PPL} FROM (SELECT event_type, value / 100 AS l, json_extract_string(props, '$.k')::INTEGER + 1 AS k FROM events) GROUP BY event_type")
def token_weighted_ppl(spark, sf_dir):
    d = table(spark, sf_dir, "events").select("event_type", (F.col("value") / 100).alias("l"), (F.get_json_object("props", "$.k").cast("int") + 1).alias("k"))
    p = metrics.perplexity(d, F.col("l"), F.col("k"), ["event_type"])
    return p.select("event_type", "rows", "tokens", F.round("nll", 6).alias("nll"), F.round("ppl", 6).alias("ppl"))


@query("WITH a AS (SELECT lang AS grp, avg(quality) AS accuracy FROM documents JOIN labels USING (doc_id) WHERE lang IS NOT NULL GROUP BY lang) SELECT grp, round(accuracy, 6) AS accuracy FROM a UNION ALL SELECT NULL, round(avg(accuracy), 6) FROM a")
def macro_accuracy(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang").join(table(spark, sf_dir, "labels"), "doc_id")
    return metrics.macro_accuracy(d, "lang", F.col("quality") == 1).withColumn("accuracy", F.round("accuracy", 6))


@query("SELECT CASE WHEN quality = 0 AND toxic = 0 THEN 'fixed' WHEN quality = 1 AND toxic = 1 THEN 'broken' ELSE 'same' END AS outcome, count(*) AS n FROM labels GROUP BY 1")
def run_diff(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    return metrics.run_diff(lab.select("doc_id", (F.col("quality") == 1).alias("ok")), lab.select("doc_id", (F.col("toxic") == 0).alias("ok")), "doc_id", "ok")


@query("SELECT event_id, round(value - avg(value) OVER (PARTITION BY user_id), 9) AS advantage FROM events")
def group_relative_reward(spark, sf_dir):
    d = metrics.group_relative(table(spark, sf_dir, "events"), "user_id", "value")
    return d.select("event_id", F.round("advantage", 9).alias("advantage"))


@query("SELECT lang, source, grouping(lang, source)::INTEGER AS over, count(*) AS n FROM documents GROUP BY ROLLUP (lang, source)")
def rollup_counts(spark, sf_dir):
    return metrics.counts_with_totals(table(spark, sf_dir, "documents"), "lang", "source")


def _targets(spark, sf_dir):
    """One target a label: the mean of its vectors."""
    e = table(spark, sf_dir, "embeddings").select("label", F.posexplode("embedding").alias("i", "x"))
    m = e.groupBy("label", "i").agg(F.avg(F.col("x").cast("double")).alias("x"))
    return m.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))), lambda s: s["x"]).alias("v"))


def _best(spark, sf_dir):
    return similarity.best_targets(table(spark, sf_dir, "embeddings"), _targets(spark, sf_dir), "embedding", "label", "v")


_BEST = """
WITH m AS (SELECT label, list(x ORDER BY i) AS v FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL) GROUP BY label
), s AS (SELECT vec_id, e.label AS own, m.label AS best_target_id, list_cosine_similarity(embedding::DOUBLE[], v) AS score FROM embeddings e, m
), b AS (SELECT vec_id, own, best_target_id, score FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY round(score, 12) DESC, best_target_id) = 1)
"""


@query(_BEST + "SELECT vec_id, best_target_id, round(score, 6) AS similarity_score FROM b")
def sim_argmax(spark, sf_dir):
    return _best(spark, sf_dir).select("vec_id", "best_target_id", F.round("similarity_score", 6).alias("similarity_score"))


@query(_BEST + "SELECT vec_id, best_target_id, round(score, 6) AS similarity_score FROM b ORDER BY score DESC, vec_id LIMIT 100")
def sim_topk(spark, sf_dir):
    return similarity.top_k(_best(spark, sf_dir), 100, "similarity_score", "vec_id").select("vec_id", "best_target_id", F.round("similarity_score", 6).alias("similarity_score"))


@query(_BEST + ", t AS (SELECT * FROM b ORDER BY score DESC, vec_id LIMIT 100) SELECT * FROM (SELECT count(score) AS n_scored, round(avg(score), 6) AS mean_score, round(max(score), 6) AS max_score FROM b), (SELECT count(*) AS n_selected, round(min(score), 6) AS min_selected, round(max(score), 6) AS max_selected FROM t)")
def sim_report(spark, sf_dir):
    scored = _best(spark, sf_dir).select("vec_id", "similarity_score")
    return metrics.score_report(scored, similarity.top_k(scored, 100, "similarity_score", "vec_id"))


@query(_BEST + "SELECT round(floor(score / 0.1) * 0.1, 6) AS low, count(*) AS n FROM b GROUP BY 1")
def sim_histogram(spark, sf_dir):
    return similarity.score_histogram(_best(spark, sf_dir), "similarity_score")


@query(_BEST + "SELECT best_target_id, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS part FROM b GROUP BY 1")
def sim_by_target(spark, sf_dir):
    n = _best(spark, sf_dir).groupBy("best_target_id").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("t"))
    return n.crossJoin(total).select("best_target_id", "n", F.round(F.col("n") / F.col("t"), 6).alias("part"))


@query()
def hash_embed_best(spark, sf_dir):
    """Every document's most similar benchmark item by hash embeddings."""
    best = similarity.best_hashed(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"), "text", "item_id", "text")
    return best.select("doc_id", "best_target_id", F.round("similarity_score", 8).alias("similarity_score"))


@query("WITH a AS (SELECT doc_id FROM documents ORDER BY n_chars DESC, doc_id::VARCHAR LIMIT 200), b AS (SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 200), j AS (SELECT a.doc_id AS x, b.doc_id AS y FROM a FULL JOIN b USING (doc_id)) SELECT count(*) FILTER (WHERE y IS NULL) AS only_a, count(*) FILTER (WHERE x IS NULL) AS only_b, count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) AS in_both, round(count(*) FILTER (WHERE x IS NOT NULL AND y IS NOT NULL) / count(*), 6) AS jaccard FROM j")
def selection_overlap(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return similarity.compare_selections(sample.longest(d, 200, F.col("n_chars"), "doc_id"), sample.hash_sample(d, 200, "doc_id"), "doc_id")


@query(f"SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l USING (doc_id) QUALIFY row_number() OVER (PARTITION BY lower({_squeeze('source')}) ORDER BY quality DESC NULLS LAST, d.doc_id) = 1")
def best_answer(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return dedup.best_answer(d, F.col("source"), F.col("quality"), F.col("doc_id")).select("doc_id", "quality")


@query(f"SELECT 'long-' || (row_number() OVER (ORDER BY n DESC, doc_id::VARCHAR) - 1) AS id, doc_id, n AS n_out FROM (SELECT doc_id, length({_strip('text')}) AS n FROM documents) WHERE n >= 200 ORDER BY n DESC, doc_id::VARCHAR LIMIT 50")
def longest_n(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.length(text.plain(F.col("text"))).cast("long").alias("n_out")).where("n_out >= 200")
    top = sample.longest(d, 50, F.col("n_out"), "doc_id")
    return sample.numbered(top, "long", [F.col("n_out").desc(), F.col("doc_id").cast("string")]).select("id", "doc_id", "n_out")


@query("SELECT doc_id, source FROM documents ORDER BY doc_id LIMIT 100")
def head_sample(spark, sf_dir):
    return sample.head_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), 100, "doc_id")


@query("SELECT doc_id, source FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 100")
def hash_sample(spark, sf_dir):
    return sample.hash_sample(table(spark, sf_dir, "documents").select("doc_id", "source"), 100, "doc_id")


@query("WITH j AS (SELECT doc_id, coalesce(toxic = 1, FALSE) AS high, md5('42:' || doc_id) AS h FROM documents LEFT JOIN labels USING (doc_id)), c AS (SELECT count(*) FILTER (WHERE high) AS nh, count(*) FILTER (WHERE NOT high) AS nr FROM j), q AS (SELECT least(nh, 100 - least(100 - least(30, nh), nr)) AS th, least(100 - least(30, nh), nr) AS tr FROM c), r AS (SELECT doc_id, high, row_number() OVER (PARTITION BY high ORDER BY h, doc_id) AS k FROM j) SELECT doc_id, high AS is_high FROM r, q WHERE k <= CASE WHEN high THEN th ELSE tr END")
def stratified_sample(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left").withColumn("is_high", F.coalesce(F.col("toxic") == 1, F.lit(False)))
    return sample.stratified(d, 100, F.col("is_high"), "doc_id").select("doc_id", "is_high")


@query("SELECT doc_id, CASE WHEN substr(md5('42:' || doc_id), 1, 4) < '028f' THEN 'val' ELSE 'train' END AS split FROM documents")
def train_val_split(spark, sf_dir):
    return sample.hash_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", 0.01)


@query("SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= floor(count(*) OVER () * 0.1) THEN 'val' ELSE 'train' END AS split FROM documents")
def ordered_split(spark, sf_dir):
    return sample.ordered_split(table(spark, sf_dir, "documents").select("doc_id"), 0.1, "doc_id")


@query("SELECT doc_id, lang, source FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) <= 3")
def group_limit(spark, sf_dir):
    return sample.group_limit(table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), 3, ["lang", "source"], "doc_id")


_BENCH = "SELECT item_id, " + _strip("regexp_replace(text, '\\r\\n?', chr(10), 'g')") + " AS q, split_part(text, ' ', 1) AS a, split_part(text, ' ', 2) AS b, split_part(text, ' ', 3) AS c, split_part(text, ' ', 4) AS d, substr('ABCDEx', (item_id % 6)::INTEGER + 1, 1) AS answer FROM benchmark"


@query(f"SELECT item_id, CASE WHEN q = '' THEN 'missing_question' WHEN a = '' OR b = '' OR c = '' OR d = '' THEN 'missing_option' WHEN upper(answer) NOT IN ('A', 'B', 'C', 'D') THEN 'invalid_answer' ELSE 'kept' END AS reason, CASE upper(answer) WHEN 'A' THEN {_strip('a')} WHEN 'B' THEN {_strip('b')} WHEN 'C' THEN {_strip('c')} WHEN 'D' THEN {_strip('d')} END AS answer_text FROM ({_BENCH})")
def benchmark_records(spark, sf_dir):
    """Multiple-choice rows made of the benchmark's texts: validity and the answer's option."""
    b = table(spark, sf_dir, "benchmark")
    w = F.split("text", " ")
    d = b.select("item_id", F.col("text").alias("question"), *(F.coalesce(F.get(w, F.lit(i)), F.lit("")).alias(k) for i, k in enumerate("ABCD")), F.substring(F.lit("ABCDEx"), (F.col("item_id") % 6 + 1).cast("int"), F.lit(1)).alias("answer"), F.lit("").alias("explanation"))
    r = convert.benchmark_records(d, F.lit("s"), F.lit("test"), F.col("item_id"))
    return r.select(F.regexp_extract("id", r"(\d+)$", 1).cast("long").alias("item_id"), F.coalesce("reason", F.lit("kept")).alias("reason"), "answer_text")


@query(f"WITH p AS ({_PAIRS}) SELECT conv_id, turn FROM p WHERE length(question || answer) BETWEEN 1 AND 1024 AND length(question || question) BETWEEN 1 AND 1024")
def preference_filter(spark, sf_dir):
    p = pairs(spark, sf_dir)
    return p.where(rules.preference_fits(F.col("question"), F.col("answer"), F.col("question"), 1024)).select("conv_id", "turn")


@query("WITH a AS (SELECT text, greatest(length(text), 1) AS n, length(regexp_replace(text, '[^\\pL]', '', 'g')) AS l, len(regexp_extract_all(text, 'https?://|www[.]')) AS m FROM documents), r AS (SELECT CASE WHEN contains(text, chr(65533)) OR regexp_matches(text, 'Ã[\\x{80}-\\x{bf}]') THEN 'misencoded' WHEN l / n < 0.3 THEN 'garbled' WHEN m > 3 THEN 'marketing' WHEN regexp_matches(text, '[,;:，：；]\\s*$') THEN 'truncated' ELSE 'kept' END AS reason FROM a) SELECT reason, count(*) AS n FROM r GROUP BY 1")
def junk_reasons(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.coalesce(rules.junk_reason(F.col("text")), F.lit("kept")).alias("reason"))
    return metrics.counts_by(d, "reason")


@query(f"SELECT count(*) AS total_read, sum((t = '')::INTEGER)::BIGINT AS skipped_empty_text, sum((t <> '')::INTEGER)::BIGINT AS encoded FROM (SELECT {_strip("regexp_replace(coalesce(text, ''), '[^!?]', '', 'g')")} AS t FROM documents)")
def candidate_counts(spark, sf_dir):
    """Candidates without text are skipped and counted (texts are reduced to their exclamation and question marks, so that some are empty)."""
    return similarity.candidate_report(table(spark, sf_dir, "documents"), F.regexp_replace("text", "[^!?]", ""))


@query(f"WITH p AS ({_PAIRS}) SELECT conv_id, turn, sha256(lower({_squeeze('question')}) || chr(10) || lower({_squeeze('answer')})) AS pair_key FROM p")
def pair_keys(spark, sf_dir):
    return pairs(spark, sf_dir).select("conv_id", "turn", dedup.pair_key(F.col("question"), F.col("answer")).alias("pair_key"))


@query(f"WITH p AS ({_PAIRS}), s AS (SELECT conv_id, turn, {_strip('question')} AS i, CASE WHEN turn % 4 = 0 THEN 'more of it' WHEN turn % 4 = 2 THEN ' ' END AS n, {_strip('answer')} AS o FROM p) SELECT i || CASE WHEN turn % 4 = 0 THEN CASE WHEN i = '' THEN '' ELSE chr(10) || chr(10) END || n ELSE '' END AS prompt, o AS reply FROM s WHERE (i <> '' OR turn % 4 = 0) AND o <> ''")
def single_to_chat_with_input(spark, sf_dir):
    """Instruction and input are joined by a blank line, an empty input adds none."""
    extra = F.when(F.col("turn") % 4 == 0, "more of it").when(F.col("turn") % 4 == 2, " ")
    d = pairs(spark, sf_dir).select(F.col("question").alias("instruction"), extra.alias("input"), F.col("answer").alias("output"))
    c = convert.single_to_chat(d)
    return c.select(F.col("conversations")[0]["value"].alias("prompt"), F.col("conversations")[1]["value"].alias("reply"))


@query()
def clean_lines_report(spark, sf_dir):
    """The whole cleaning plan over JSON lines made of pairs, chats and documents."""
    qa = pairs(spark, sf_dir).select(F.lit("qa").alias("file"), F.struct("conv_id", "turn").alias("ord"), F.to_json(F.struct("question", "answer")).alias("value"))
    multi = chats(spark, sf_dir).select(F.lit("chat").alias("file"), F.struct("conv_id", F.lit(0).cast("long").alias("turn")).alias("ord"), F.to_json(F.struct("conversations")).alias("value"))
    docs = table(spark, sf_dir, "documents").select(F.lit("docs").alias("file"), F.struct(F.col("doc_id").alias("conv_id"), F.lit(0).cast("long").alias("turn")).alias("ord"), F.to_json(F.struct(F.col("source").alias("instruction"), F.col("lang").alias("input"), F.col("text").alias("output"))).alias("value"))
    return cleaning.report(cleaning.classify(qa.unionByName(multi).unionByName(docs), CLEAN))
