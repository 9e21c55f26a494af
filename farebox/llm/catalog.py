"""Registered corpus queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farebox.llm import alignment, chat, divergence, langid, mixing, neighbours, packing, rules, search, secrets, simhash, substring, suffix
from farebox.llm.common import ready
from farebox.tables import load

REGISTRY: dict[str, tuple] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return load(spark, sf_dir, name)


@register("op1_simhash")
def op1_simhash(spark, sf_dir):
    g = simhash.simhash_groups(table(spark, sf_dir, "documents"), "doc_id", "text", shingle=3, max_bits=2)
    return g.select(F.col("id").alias("doc_id"), "fingerprint", "component_id")


@register("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    out = substring.substring_dedup(table(spark, sf_dir, "documents"), "doc_id", "text", window=13)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark, sf_dir):
    out = suffix.suffix_dedup(table(spark, sf_dir, "documents"), "doc_id", "text", window=100)
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


@register("op4_language")
def op4_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out("doc_id", 4, 2)
    pred = langid.identify(docs, docs.where(~out), "doc_id", "text", "lang")
    return pred.withColumnRenamed("id", "doc_id").select("doc_id", out.alias("held_out"), "lang_pred", "score")


@register("op6_quality")
def op6_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = langid.held_out("doc_id", 5, 0)
    pred = neighbours.quality(docs, labels.where(~out), "doc_id", "text", "quality").withColumnRenamed("id", "doc_id")
    return pred.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op7_packing")
def op7_packing(spark, sf_dir):
    out = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), "doc_id", "text", "source", length=4096, end_id=2)
    return out.select(F.col("id").alias("doc_id"), "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


#: Lengths of the marks around a turn, by role, and the escaped characters.
CHAT_SQL = """
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(regexp_replace(text, '([\\\\\\[<])', 'xx', 'g'))
      + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
        ELSE 20 + length(regexp_replace(role, '([\\\\\\[<])', 'xx', 'g')) END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


@register("op10_chat", CHAT_SQL)
def op10_chat(spark, sf_dir):
    talks = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    planted = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", planted), (-7, 1, "assistant", planted)], talks.schema)
    out = chat.digests(chat.format_chat(talks.unionAll(extra)))
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


@register("op8_quality_rules")
def op8_quality_rules(spark, sf_dir):
    out = rules.quality_rules(table(spark, sf_dir, "documents"), "doc_id", "text", "lang", "source")
    return out.withColumnRenamed("id", "doc_id").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2"
    )


#: The tree of the mixing query: domain (from the source's number), language, source.
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.5, 2, 17


def mix_levels():
    number = F.try_to_number(F.regexp_extract(F.coalesce(F.col("source"), F.lit("")), r"(\d+)", 1), F.lit("999999999")).cast("long")
    domain = F.concat(F.lit("d"), F.coalesce(number % 4, F.lit(0)).cast("string"))
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def _share_sql(name: str, nodes: str, parents: str, level: str) -> str:
    by = f"PARTITION BY {parents}" if parents else ""
    order = f"ORDER BY cap / w, {level}"
    keys = ", ".join(x for x in (parents, level) if x)
    return f"""{name}_a AS (SELECT *, coalesce(sum(cap) OVER ({by} {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    sum(w) OVER ({by} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_w FROM ({nodes})),
  {name}_b AS (SELECT *, cap * open_w <= w * (budget - before) AS is_full FROM {name}_a),
  {name}_c AS (SELECT *, coalesce(sum(cap) FILTER (WHERE is_full) OVER ({by}), 0) AS taken, sum(w) FILTER (WHERE NOT is_full) OVER ({by}) AS rest_w FROM {name}_b),
  {name} AS (SELECT {keys}, CAST(CASE WHEN is_full THEN cap ELSE ((budget - taken) * w) // rest_w END AS BIGINT) AS budget FROM {name}_c)"""


def _weight_sql(level: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS.get(level, {}).items())
    return f"CASE {level} {cases} ELSE 1 END" if cases else "1"


MIX_SQL = f"""
WITH docs AS (SELECT coalesce(doc_id, 9223372036854775807) AS doc_id,
    'd' || CAST(coalesce(TRY_CAST(regexp_extract(coalesce(source, ''), '(\\d+)', 1) AS BIGINT) % 4, 0) AS VARCHAR) AS domain,
    coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS n_tokens FROM documents),
  leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS tokens FROM docs GROUP BY ALL),
  fed AS (SELECT * FROM leaves WHERE {_weight_sql('domain')} > 0 AND {_weight_sql('lang')} > 0),
  total AS (SELECT CAST(floor(sum(tokens) * {MIX_SHARE}) AS BIGINT) AS budget FROM leaves),
  {_share_sql('b1', f"SELECT domain, CAST(sum(tokens) * {MIX_EPOCHS} AS BIGINT) AS cap, {_weight_sql('domain')} AS w, (SELECT budget FROM total) AS budget FROM fed GROUP BY domain HAVING cap > 0", '', 'domain')},
  {_share_sql('b2', f"SELECT domain, lang, CAST(sum(tokens) * {MIX_EPOCHS} AS BIGINT) AS cap, {_weight_sql('lang')} AS w, any_value(b1.budget) AS budget FROM fed JOIN b1 USING (domain) GROUP BY domain, lang HAVING cap > 0", 'domain', 'lang')},
  {_share_sql('b3', f"SELECT domain, lang, source, CAST(sum(tokens) * {MIX_EPOCHS} AS BIGINT) AS cap, 1 AS w, any_value(b2.budget) AS budget FROM fed JOIN b2 USING (domain, lang) GROUP BY domain, lang, source HAVING cap > 0", 'domain, lang', 'source')},
  plan AS (SELECT *, budget // tokens AS whole, budget - (budget // tokens) * tokens AS rest FROM leaves JOIN b3 USING (domain, lang, source)),
  keyed AS (SELECT *, md5('{MIX_SEED}:' || whole || ':' || doc_id) AS key FROM docs JOIN plan USING (domain, lang, source)),
  part AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM keyed)
SELECT doc_id, domain, lang, source, n_tokens, epoch, tokens AS leaf_tokens, budget AS leaf_budget
FROM (SELECT *, unnest(range(whole)) AS epoch FROM keyed)
UNION ALL SELECT doc_id, domain, lang, source, n_tokens, whole AS epoch, tokens, budget FROM part WHERE before < rest
"""


@register("op5_mixing", MIX_SQL)
def op5_mixing(spark, sf_dir):
    out = mixing.mix(table(spark, sf_dir, "documents"), mix_levels(), MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return out.select(F.col("_id").alias("doc_id"), "domain", "lang", "source", "n_tokens", "epoch", "leaf_tokens", "leaf_budget")


#: Every term of the query text that another document holds too.
SEARCH_SQL = """
WITH w AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')) AS term FROM documents),
  tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY ALL),
  df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
  dl AS (SELECT doc_id, sum(tf) AS dl FROM tf GROUP BY doc_id),
  n AS (SELECT count(*) AS n, (SELECT sum(tf) FROM tf) / count(*) AS mean FROM documents),
  asked AS (SELECT doc_id AS query_id, term, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf FROM tf JOIN df USING (term), n WHERE doc_id % 100 = 0 AND df >= 2),
  hits AS (SELECT query_id, doc_id, round(sum(idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * dl / mean))), 6) AS score
    FROM asked JOIN tf USING (term) JOIN dl USING (doc_id), n GROUP BY query_id, doc_id),
  top AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM hits)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM top WHERE rank <= 10
"""


@register("op9_bm25", SEARCH_SQL)
def op9_bm25(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = search.search(docs, docs.where("doc_id % 100 = 0"), "doc_id", "text", k=10)
    return out.select("query_id", "rank", F.col("id").alias("doc_id"), "score")


@register("op11_secrets")
def op11_secrets(spark, sf_dir):
    out = secrets.digests(secrets.scan(table(spark, sf_dir, "documents"), "doc_id", "text", reach=200))
    return out.withColumnRenamed("id", "doc_id").select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


AUDIT_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
  w AS (SELECT doc, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
  kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
  langs AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
  c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
  groups AS (SELECT DISTINCT lang, source FROM d),
  totals AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN c USING (lang, source) GROUP BY ALL),
  p AS (SELECT lang, source, term, coalesce(c.n, 0) AS n, CAST(1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (t.total + 2 * l.v) AS BIGINT) AS p
    FROM totals t JOIN langs l USING (lang) JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
  q AS (SELECT lang, term, CAST(1 + (1000000000 * (n + 2)) // (l.total + 2 * l.v) AS BIGINT) AS q FROM kept JOIN langs l USING (lang)),
  f AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
  pair AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
    FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source LEFT JOIN f ON f.lang = g.lang AND f.source = g.source AND f.item = h.source),
  term AS (SELECT lang, source, 'term' AS part, term AS item, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
  ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@register("op12_divergence", AUDIT_SQL)
def op12_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"), "text", "lang", "source", min_docs=10, top=10)


@register("op13_alignment")
def op13_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out, _ = alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), "doc_id", "text")
    return out.withColumnRenamed("id", "doc_id").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def pipeline(spark, sf_dir):
    """The stages of corpus_pipeline.py (beside the package), one after the other."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


REGISTRY["pipeline"] = (pipeline, None)
