"""One query per text operator, over whole tables, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragcube.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_exact_dedup", """
    with n as (select doc_id, length(coalesce(text, '')) as chars,
                      regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') as norm from documents)
    select doc_id, first_value(doc_id) over w as keep_id, count(*) over (partition by norm) as group_size,
           doc_id = first_value(doc_id) over w as kept, sha256(norm) as text_sha256
    from n window w as (partition by norm order by chars desc, doc_id)
""")
def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.exact import decide

    return decide(table(spark, sf_dir, "documents"))


@query("op6_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.language import identify, learn

    docs = table(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3)) == 1
    names, log_p = learn(docs, ~held_out)
    return identify(docs, names, log_p).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "languages")


@query("op7_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from fragcube.llm.bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op8_quality_rules")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.quality import judge, train

    docs = table(spark, sf_dir, "documents")
    return judge(docs, train(docs, table(spark, sf_dir, "labels")))


@query("op9_best_fit_packing")
def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.packing import pack

    return pack(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


@query("op10_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.mixing import score

    return score(table(spark, sf_dir, "documents"))


@query("op2_ngram_jaccard", """
    with recursive w as (
      select doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\\x20\\x09-\\x0D]+') if x <> ''] as ws from documents),
    s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s from w, unnest(range(1, greatest(len(ws) - 3, 2))) t(i) where len(ws) > 0),
    n as (select doc_id, count(*) as n from s group by doc_id),
    o as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
    links as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * k >= 80 * (x.n + y.n - k)),
    reach as (select doc_id as a, doc_id as b from documents union select r.a, l.b from reach r join links l on l.a = r.b)
    select d.doc_id, coalesce(any_value(n.n), 0) as n_shingles, min(r.b) as component_id
    from documents d left join n on n.doc_id = d.doc_id join reach r on r.a = d.doc_id group by d.doc_id
""")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.jaccard import join

    return join(table(spark, sf_dir, "documents"))


@query("op5_substring_dedup", """
    with w as (
      select doc_id, [x for x in string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+') if x <> ''] as ws from documents),
    win as (select doc_id, i, array_to_string(ws[i:i + 49], ' ') as s from w, unnest(range(1, len(ws) - 48)) t(i)),
    least_doc as (select s, min(doc_id) as lo from win group by s),
    gone as (select distinct doc_id, unnest(range(i, i + 50)) as p from win join least_doc using (s) where lo < doc_id),
    words as (select doc_id, unnest(ws) as x, unnest(range(1, len(ws) + 1)) as p from w),
    kept as (select doc_id, count(*) as n, string_agg(x, ' ' order by p) as t from words anti join gone using (doc_id, p) group by doc_id)
    select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(kept.n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
    from w left join kept using (doc_id)
""")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.substring import cut

    return cut(table(spark, sf_dir, "documents"))


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


LICENSE_SQL = f"""
    with low as (
      select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low from documents),
    w as (select doc_id, [x for x in string_split_regex(low, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') if x <> ''] as ws from low),
    phrases(phrase, label, k) as (values {_values([(p, x, len(p.split())) for p, x in PHRASES.items()])}),
    places as (select doc_id, i, label from w, phrases, unnest(range(1, len(ws) - k + 2)) t(i) where array_to_string(ws[i:i + k - 1], ' ') = phrase),
    base as (select doc_id, count(*) as n, min(i) - 1 as first_word, max(i) - 1 as last_word, list(distinct label) as labels from places group by doc_id),
    templates(id, label, words, width) as (values {", ".join(f"({i}, '{x}', {sorted(set(t.split()))!r}, {ceil(len(t.split()) / THRESHOLD - 1e-9)})" for i, (x, t) in enumerate(TEMPLATES))}),
    block as (select doc_id, unnest(string_split(regexp_replace(low, '[.!?]([ \\t\\n\\x0B\\f\\r])', chr(10) || '\\1', 'g'), chr(10))) as line from low),
    sets as (select doc_id, string_split_regex(line, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as own from block),
    likely as (select doc_id, ws, label, words, width from w, templates where len(list_intersect(words, ws)) >= {THRESHOLD} * len(words)),
    runs as (select doc_id, label, words, ws[i:i + width - 1] as own from likely, unnest(range(1, len(ws) + 1)) t(i)),
    blocks as (select doc_id, label, words, own from sets, templates union all select doc_id, label, words, own from runs),
    hits as (select doc_id, label, len(list_intersect(words, own)) / len(words) as share from blocks
             where len(list_intersect(words, own)) >= {THRESHOLD} * len(words)),
    more as (select doc_id, list(distinct label) as labels, max(share) as best from hits group by doc_id)
    select w.doc_id, len(ws)::bigint as n_words, coalesce(n, 0) as n_base, first_word::bigint as first_word, last_word::bigint as last_word,
           array_to_string(list_sort(coalesce(base.labels, [])), ',') as base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') as labels,
           (case when n > 0 then 1.0 else coalesce(best, 0.0) end)::double as score
    from w left join base using (doc_id) left join more using (doc_id)
"""


@query("op4_license_scan", LICENSE_SQL)
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.licenses import scan

    return scan(table(spark, sf_dir, "documents"), wrapped=True)


@query("op1_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.urls import filter_urls

    return filter_urls(table(spark, sf_dir, "pages"))


@query("op11_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the documents, of which one in ten first repeats a stretch of its words up to its end."""
    from fragcube.llm.periods import repeated_runs

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    docs = docs.withColumn("words", F.when(F.col("h") % 10 == 0, F.expr("filter(split(text, '[\\\\x20\\\\x09-\\\\x0D]+'), w -> w <> '')")))
    docs = docs.withColumn("n", F.size("words")).withColumn("a", F.expr("if(n > 0, (h div 10) % n, 0)"))
    again = F.expr("array_join(transform(sequence(0, n - 1), i -> words[int(if(i < a, i, a + (i - a) % (1 + (n - a) div (3 + (h div 10) % 8))))]), ' ')")
    found = repeated_runs(docs.select("doc_id", F.when(F.col("n") > 0, again).otherwise(F.col("text")).alias("text")))
    longest = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as s, -r.period as p)))")
    lines = F.expr("array_join(transform(runs, r -> concat_ws(',', r.start, r.length, r.period) || chr(10)), '')")
    found = found.select("doc_id", "runs", "collapsed", longest.alias("x"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.expr("-x.s").alias("start"), F.expr("x.length").alias("length"), F.expr("-x.p").alias("period"),
        F.expr("1000 * x.length div -x.p").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


#: CRC-32 of a number in decimal, bit by bit.
CRC32_SQL = """xor(list_reduce(list_prepend(4294967295::bigint, [ascii(x)::bigint for x in string_split({}::varchar, '')]), lambda a, b:
      list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: if(c % 2 = 1, xor(c // 2, 3988292384), c // 2))), 4294967295)"""


@query("op12_conversation_trie", f"""
    with t as (select conv_id, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null),
    k as (select conv_id, coalesce(role, '') as r, coalesce(text, '') as x,
                 row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) as k
          from conversations where conv_id is not null),
    ids as (select conv_id, conv_id - conv_id % 100 as base, {CRC32_SQL.format("conv_id")} % 6 as h from (select distinct conv_id from t)),
    turns as (
      select i.conv_id, 0 as part, k.k, k.r, k.x from ids i join k on k.conv_id = i.base and k.k <= i.h
      union all select i.conv_id, 1, k.k, k.r, k.x from ids i join k on k.conv_id = i.conv_id and k.k > i.h),
    seqs as (select i.conv_id, coalesce(list({{'r': r, 'x': x}} order by part, k) filter (where r is not null), []) as s
             from ids i left join turns using (conv_id) group by i.conv_id),
    steps as (select conv_id, unnest(range(0, len(s) + 1)) as d, s from seqs),
    nodes as (select s[1:d] as path, d, min(conv_id) as conv_id, count(*) as n, any_value(coalesce(length(s[d].x), 0)) as chars,
                     coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(s) = d), '') as ends
              from steps group by all),
    children as (select path[1:d - 1] as path, count(*) as c from nodes where d > 0 group by 1),
    own as (select n.*, coalesce(c, 0) as c, case when d = 0 then 0 else (n - 1) * chars end as saved from nodes n left join children using (path)),
    below as (select path[1:u] as path, count(*) filter (where c = 0) as leaves, sum(saved) as saved
              from (select path, c, saved, unnest(range(0, d + 1)) as u from own) group by 1)
    select o.conv_id, o.d as depth, p.conv_id as parent_conv_id, o.n as n_convs, o.c as n_children, b.leaves as n_leaves,
           b.saved::bigint as saved_tokens, sha256(o.ends) as ends_sha256
    from own o join below b using (path) left join nodes p on p.path = o.path[1:o.d - 1] and o.d > 0
""")
def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the conversations, which first borrow up to five turns from the first conversation of their hundred."""
    from fragcube.llm.tries import sequences, trie, with_heads

    conversations = table(spark, sf_dir, "conversations")
    lent = sequences(conversations.filter("conv_id % 100 = 0"))
    return trie(with_heads(sequences(conversations), lent, "conv_id - conv_id % 100", "crc32(cast(cast(conv_id as string) as binary)) % 6"))


@query("op13_embedding_near_dedup", """
    with recursive v as (
      select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
    ok as (select vec_id, e from v where e is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
           and len(list_filter(e, lambda x: x <> 0)) > 0),
    links as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.9),
    n as (select a, count(*) as n from links group by a),
    reach as (select vec_id as a, vec_id as b from embeddings union select r.a, l.b from reach r join links l on l.a = r.b),
    least as (select a, min(b) as component_id from reach group by a)
    select vec_id, coalesce(n.n, 0) as n_links, component_id, vec_id = component_id as kept
    from embeddings left join n on n.a = vec_id join least on least.a = vec_id
""")
def embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fragcube.llm.vectors import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings"))
