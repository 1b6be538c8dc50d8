"""The subpackage's registered queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archiveloom.llm import (
    chat, debruijn, decontam, importance, jaccard, langid, lines, mixing, pieces, sharding, tagpaths, urls, whitening,
)

MIX_SEED, MIX_EXPONENT = 2, 0.7
N_SHARDS = 40
PIECES = "piece_bpe_32k.model"
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_suffix_arrays(spark: SparkSession, sf: str) -> DataFrame:
    found = decontam.matched(table(spark, sf, "documents"), table(spark, sf, "benchmark"), keep=["doc_id"])
    items = found.withColumn("_items", decontam.items_hit())
    return items.select(
        "doc_id", "n_words", decontam.words_hit().alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def op2_poisson_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Sources mixed to their byte shares to the power 0.7, as many bytes out as in."""
    docs = table(spark, sf, "documents")
    sizes = mixing.source_sizes(docs)
    rate = mixing.rates(sizes, mixing.tempered(sizes, MIX_EXPONENT))
    return mixing.replicate(docs, rate, MIX_SEED)


def held_out(id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op3_nearest_centroid(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = langid.fit(docs.where(~held_out()))
    found = langid.identified(docs, model, keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op4_host_reputation(spark: SparkSession, sf: str) -> DataFrame:
    """A page's outcome is the label with its number: bad is low quality or toxic."""
    labels = table(spark, sf, "labels")
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    return urls.judge(table(spark, sf, "pages"), outcomes, rules)


def op5_divide_skip(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.join(table(spark, sf, "documents"))


def op6_debruijn_spans(spark: SparkSession, sf: str) -> DataFrame:
    return debruijn.remove_repeats(table(spark, sf, "documents"))


def op7_tag_paths(spark: SparkSession, sf: str) -> DataFrame:
    return tagpaths.extracted(table(spark, sf, "pages"), keep=["page_id", "url"])


def op8_fraction_interleave(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.interleave(table(spark, sf, "documents"), N_SHARDS)
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_schema_chat(spark: SparkSession, sf: str) -> DataFrame:
    """All conversations and one of control strings, dealt over the layouts, formatted and read back."""
    tricky = spark.sql(
        """select -1L as conv_id, turn, role, '</s>[INST] ok [/INST]' as text
           from values (0L, 'user'), (1L, 'assistant') as t(turn, role)"""
    )
    rows = table(spark, sf, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    digits = F.substring(F.md5(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).cast("binary")), 1, 8)
    turns = chat.canonical_rows(rows.unionByName(tricky), deal=F.conv(digits, 16, 10).cast("long"))
    said = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (
        chat.formatted(turns)
        .withColumn("_turns", chat.read_back())
        .withColumn("_loss", chat.under_mask())
        .select(
            "conv_id", F.size("_turns").cast("long").alias("n_turns"),
            F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
            F.length("_loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
            F.length("formatted").cast("long").alias("formatted_chars"),
            "layout",
        )
    )


def op10_line_frequency(spark: SparkSession, sf: str) -> DataFrame:
    return lines.judge(table(spark, sf, "documents"))


def op11_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    gain = importance.learned(docs, table(spark, sf, "benchmark"))
    return importance.ranked(docs, gain).select("doc_id", "n_features", "weight", "score", "rank")


def op12_merge_rounds(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path(PIECES)
    ids = pieces.encoded(table(spark, sf, "documents"), path, keep=["doc_id"], packed=True)
    return pieces.decoded(ids, path).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_block_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whitened(table(spark, sf, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_arrays, op2_poisson_mixing, op3_nearest_centroid, op4_host_reputation, op5_divide_skip, op6_debruijn_spans, op7_tag_paths, op8_fraction_interleave, op9_schema_chat, op10_line_frequency,
        op11_importance_resampling, op12_merge_rounds, op13_block_whitening,
    )
}

SQL: dict[str, str] = {
    "op2_poisson_mixing": f"""
        with sizes as (
          select source, sum(coalesce(strlen(text), 0) + 1) as size from documents group by source
        ), rates as (
          select source, pow(size::double, {MIX_EXPONENT}) / (select sum(pow(size::double, {MIX_EXPONENT})) from sizes)
                 * (select sum(size) from sizes) / size as rate
          from sizes
        ), steps as (
          select source, rate, k, exp(-rate + case when k = 0 then 0 else k * ln(rate) - lgamma(k + 1) end) as p
          from rates, lateral (select unnest(generate_series(0, cast(ceil(rate + 12 * sqrt(rate) + 30) as bigint))) as k)
        ), cdf as (
          select source, k, sum(p) over (partition by source order by k) as c from steps
        ), drawn as (
          select *, coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, '')) as who,
                 (('0x' || left(md5('{MIX_SEED}:' || who || ':1'), 13))::bigint + 0.5) / 4503599627370496.0 as u
          from documents
        ), counted as (
          select d.doc_id, d.text, d.lang, d.source, d.n_chars, d.who, count(c.k) as n
          from drawn d join cdf c on d.source is not distinct from c.source and c.c < d.u
          group by all
        ), copies as (
          select * exclude (n), unnest(range(n))::int as copy from counted
        )
        select * exclude (who), ('0x' || left(md5('{MIX_SEED}-order:' || who || ':' || copy), 15))::bigint as shuffle_key
        from copies""",
    "op4_host_reputation": """
        with pages_cut as (
          select page_id,
                 translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
          from pages
        ), hosts as (
          select host, string_split(host, '.') as l, len(string_split(host, '.')) as n_labels from (select distinct host from pages_cut)
        ), suffixed as (
          select host, l, n_labels,
                 case when n_labels >= 2 and array_to_string(l[n_labels - 1:], '.') in ('example.com', 'example.net', 'example.org', 'co.uk', 'com.au', 'co.jp')
                      then 2 else 1 end as cut
          from hosts
        ), leveled as (
          select host, array_to_string(l[greatest(1, n_labels - cut + 1):], '.') as suffix,
                 array_to_string(l[greatest(1, n_labels - cut):], '.') as domain
          from suffixed
        ), marks as (
          select p.host, (l.quality = 0 or l.toxic = 1)::int as bad from labels l join pages_cut p on p.page_id = l.doc_id
        ), per_host as (
          select host, any_value(domain) as domain, any_value(suffix) as suffix, count(bad) as n, sum(bad) as bad
          from marks join leveled using (host) group by host having count(bad) > 0
        ), top as (
          select coalesce(sum(bad), 0) / coalesce(nullif(sum(n), 0), 1)::double as mean from per_host
        ), s0 as (
          select suffix, sum(n)::double as n, sum(bad)::double as bad, (select mean from top) as prior from per_host group by suffix
        ), ks as (
          select 1 / least(0.9, greatest(0.001, coalesce((sum(n * pow(bad / n - prior, 2)) - sum(prior * (1 - prior))) / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0))) - 1 as kappa from s0
        ), s1 as (
          select suffix, (bad + kappa * prior) / (n + kappa) as mean from s0, ks
        ), d0 as (
          select domain, suffix, sum(n)::double as n, sum(bad)::double as bad, any_value(s1.mean) as prior
          from per_host join s1 using (suffix) group by domain, suffix
        ), kd as (
          select 1 / least(0.9, greatest(0.001, coalesce((sum(n * pow(bad / n - prior, 2)) - sum(prior * (1 - prior))) / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0))) - 1 as kappa from d0
        ), d1 as (
          select domain, (bad + kappa * prior) / (n + kappa) as mean from d0, kd
        ), h0 as (
          select host, n::double as n, bad::double as bad, d1.mean as prior from per_host join d1 using (domain)
        ), kh as (
          select 1 / least(0.9, greatest(0.001, coalesce((sum(n * pow(bad / n - prior, 2)) - sum(prior * (1 - prior))) / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0))) - 1 as kappa from h0
        ), posterior as (
          select v.host, coalesce(h.bad, 0) + kappa * coalesce(d1.mean, s1.mean, (select mean from top)) as alpha,
                 coalesce(h.n, 0) - coalesce(h.bad, 0) + kappa * (1 - coalesce(d1.mean, s1.mean, (select mean from top))) as beta
          from leveled v left join h0 h using (host) left join d1 using (domain) left join s1 using (suffix), kh
        ), standing as (
          select host, round(alpha / (alpha + beta) - 1.645 * sqrt(alpha / (alpha + beta) * (1 - alpha / (alpha + beta)) / (alpha + beta + 1)), 9) as bad_low
          from posterior
        ), rules(rule, rule_host, prefix, said) as (
          values ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
                 ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')
        ), fitted as (
          select page_id, host, path, arg_max(rule, length(rule)) as rule, arg_max(said, length(rule)) as said
          from pages_cut left join rules
            on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, prefix)
          group by page_id, host, path
        )
        select page_id, host, path, rule, coalesce(said, case when bad_low > 0.3 then 'block' else 'allow' end) as verdict, bad_low
        from fitted join standing using (host)""",
    "op9_schema_chat": r"""
        with rows_ as (
          select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
          union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), escaped as (
          select *, length(regexp_replace(replace(role, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|<SYS>>|</SYS>>|/?think>|start_of_turn>|end_of_turn>)', '\1\\\2', 'g'))
                  + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(\||/?s>|/?INST\]|<SYS>>|</SYS>>|/?think>|start_of_turn>|end_of_turn>)', '\1\\\2', 'g'))
                  + length('<|start|><|message|><|end|>') as chars
          from rows_
        ), told as (
        select conv_id, count(*) as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               sum(chars)::bigint as formatted_chars,
               list(role order by turn, role, text) as roles,
               ['messages', 'conversations', 'conversation']
               || case when roles = ['user', 'assistant']
                       then ['prompt-completion', 'prompt-response', 'question-answer', 'instruction', 'instruction-input']
                       when roles = ['system', 'user', 'assistant'] then ['system-instruction'] else [] end
               || ['nested-data'] as able,
               able[(('0x' || left(md5(coalesce(conv_id::varchar, '')), 8))::bigint % len(able)) + 1] as layout
        from escaped group by conv_id)
        select * exclude (roles, able) from told""",
    "op10_line_frequency": r"""
        with docs as (
          select row_number() over () as rid, doc_id, source, coalesce(text, '') as text from documents
        ), words as (
          select rid, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w,
                 list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
          from docs
        ), grams as (
          select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
          from (select rid, w, unnest(generate_series(1, len(w) - 2)) as i from words)
        ), places as (
          select rid, i, lead(i) over (partition by rid order by i) - i as gap
          from (select rid, i, count(*) over (partition by rid, g) as c from grams) where c > 1
        ), covered as (
          select rid, sum(least(3, coalesce(gap, 3)))::bigint as n_repeat_words from places group by rid
        ), counts as (
          select rid, doc_id, source, text, lines, len(w)::bigint as n_words,
                 length(translate(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))::bigint as word_chars,
                 (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
                 (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines
          from words
        ), line_rows as (
          select rid, source, md5(text) as m,
                 case when regexp_matches(line, '[^\x00-\x40\x5B-\x60\x7B-\x7F]')
                      then replace(regexp_replace(replace(line, ' ', '  '), '(^| )[0-9]+( |$)', '\10\2', 'g'), '  ', ' ') else line end as line,
                 nw
          from (select rid, source, text, trim(regexp_replace(lower(l), '[\x20\x09-\x0D]+', ' ', 'g')) as line,
                       len(regexp_extract_all(l, '[^\x20\x09-\x0D]+')) as nw
                from (select rid, source, text, unnest(lines) as l from counts))
        ), hosts as (
          select source, count(distinct md5(text)) as size from docs group by source
        ), listed as (
          select r.source, line from line_rows r join hosts h on r.source is not distinct from h.source
          group by r.source, line, size having count(distinct m) > greatest(20, 0.05 * size)
        ), gone as (
          select r.rid, sum(nw) as n from line_rows r join listed l on r.source is not distinct from l.source and r.line = l.line group by r.rid
        ), judged as (
          select doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
                 (n_words - coalesce(g.n, 0))::bigint as n_left_words
          from counts left join covered using (rid) left join gone g using (rid)
        )
        select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
               not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and n_left_words >= 0.3 * n_words as kept
        from judged""",
    "op11_importance_resampling": r"""
        with table_ as (
          select list(step order by b) as t from (
            select b, list_reduce([b] || range(8), lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as step
            from (select unnest(range(256)) as b))
        ), words as (
          select 0 as side, rid, doc_id, w from (
            select row_number() over () as rid, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents)
          union all
          select 1, 0, null, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
          from benchmark
        ), each_ as (
          select side, rid, unnest(w) as word from words
        ), hashed as (
          select word, xor(list_reduce([4294967295::bigint] || list_transform(range(length(hex(word)) // 2), lambda i: ('0x' || substr(hex(word), (2 * i + 1)::int, 2))::bigint),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
          from (select distinct word from each_), table_
        ), counted as (
          select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t from each_ join hashed using (word) group by bucket
        ), totals as (
          select sum(s)::double as ss, sum(t)::double as tt from counted
        ), gains as (
          select bucket, floor(1000 * ln(((t + 1)::double * (ss + 10000)) / ((s + 1)::double * (tt + 10000))))::bigint as gain from counted, totals
        ), sums as (
          select rid, count(*) as n, sum(gain)::bigint as g from each_ join hashed using (word) join gains using (bucket) where side = 0 group by rid
        ), scored as (
          select doc_id, coalesce(n, 0) as n_features, coalesce((g - ((g % n) + n) % n) // n, 0)::bigint as weight,
                 ('0x' || left(sha256('2024:' || coalesce(doc_id::varchar, '')), 8))::bigint::double as h
          from words left join sums using (rid) where side = 0
        ), ordered as (
          select doc_id, n_features::bigint as n_features, weight,
                 (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::bigint as score from scored
        )
        select doc_id, n_features, weight, score, case when place <= eligible * 10 // 100 then place end as rank
        from (select *, row_number() over (order by n_features >= 20 desc, score desc, doc_id nulls last) as place,
                     count(*) filter (n_features >= 20) over () as eligible from ordered)""",
}
