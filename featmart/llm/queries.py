"""The registered queries of this package: each operator on its whole table, with its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalogue.base import Query, table
from ..workdir import cut
from . import exact, langid, lm, mixing, packing, pii, repair, secrets, simhash, suffixes, syncmers, trie, urls

TOKENIZER = "word_bpe_49k.json"
SHINGLE, MAX_DISTANCE = 3, 3
URL_RULES = (urls.Rule(urls.BLOCK, "net/"), urls.Rule(urls.ALLOW, "example.net/en/"), urls.Rule(urls.BLOCK, "example.com/de/"), urls.Rule(urls.ALLOW, "org/fr/"))


def tokenizer_path() -> str:
    return public_tokenizers.path(TOKENIZER)


def digest(kinds: tuple[str, ...], by_start: bool = False) -> list:
    """Of the column spans: a count per kind, the hash of the spans of these kinds, and all spans as text."""
    of_kind = lambda k: F.filter("spans", lambda s: s["kind"] == k)
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("spans", lambda s: s["kind"].isin(*kinds)) if by_start else F.concat(*[of_kind(k) for k in kinds])
    return [
        *[F.size(of_kind(k)).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    ]


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    scores = F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores")
    return found.select("doc_id", *digest(pii.BASE_KINDS), scores)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


OP2_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       row_number() over (same order by doc_id desc) = 1 as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))"""


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = mixing.taken_words(mixing.mix(table(spark, sf_dir, "documents")))
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"), SHINGLE, MAX_DISTANCE)
    return rows.select(F.col(simhash.ID).alias("doc_id"), "fingerprint", "component_id")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_documents(table(spark, sf_dir, "documents"), langid.fold("doc_id", 7) == 2)


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents")).select("doc_id", *digest(secrets.BASE_KINDS, by_start=True))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP11_SQL = """
with texts as (select doc_id, hex(encode(coalesce(text, ''))) as h from documents),
sized as (select doc_id, h, (length(h) // 2)::bigint as n from texts),
windows as (select doc_id, i, md5(substr(h, (2 * i + 1)::bigint, 400)) as w from sized, unnest(range(0, n - 199)) as t(i)),
twice as (select doc_id, i from windows qualify count(*) over (partition by w) > 1),
steps as (select doc_id, i, lag(i) over (partition by doc_id order by i) as prev from twice),
marked as (select doc_id, i, sum(case when prev is null or i > prev + 200 then 1 else 0 end) over (partition by doc_id order by i) as g from steps),
spans as (select doc_id, g, min(i) as a, max(i) + 200 as b from marked group by all),
gaps as (select doc_id, coalesce(lag(b) over (partition by doc_id order by a), 0) as f, a as t from spans
  union all select doc_id, coalesce(max(b), 0), max(n) from (select doc_id, n, b from sized left join spans using (doc_id)) group by doc_id),
kept as (select doc_id, string_agg(substr(h, (2 * f + 1)::bigint, (2 * (t - f))::bigint), '' order by f, t) as k from gaps join sized using (doc_id) group by doc_id)
select doc_id, n as n_bytes, n - (length(k) // 2)::bigint as n_removed, coalesce(c, 0)::bigint as n_spans, sha256(unhex(k)) as kept_sha256
from sized join kept using (doc_id) left join (select doc_id, count(*) as c from spans group by doc_id) using (doc_id)"""


# What SQL can state of operators that it cannot express as a whole.


def op4_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4(spark, sf_dir).select("doc_id", "n_chars", "edited_sha256")


OP4_TEXTS_SQL = """
with t as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n from documents),
pairs as (select *, coalesce(lead(text) over (order by doc_id), first_value(text) over (order by doc_id rows between unbounded preceding and unbounded following)) as following from t)
select doc_id, n as n_chars, sha256(substr(text, 1, n - n // 4) || substr(following, 1, n // 4)) as edited_sha256 from pairs"""


def op7_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op7(spark, sf_dir).select("page_id", "host", "path", "rule", F.when(F.col("rule").isNotNull(), F.col("verdict")).alias("ruled"))


OP7_RULES_SQL = f"""
with parts as (
  select page_id, coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '') as h, coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') as path from pages),
p as (select page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from parts),
rules as (select rule, split_part(rule, '/', 1) as h, substr(rule, length(split_part(rule, '/', 1)) + 1) as p, verdict
          from (values {', '.join(f"('{r.prefix}', '{r.verdict}')" for r in URL_RULES)}) as v(rule, verdict)),
fits as (select page_id, rule, verdict from p join rules r on (host = r.h or ends_with(host, '.' || r.h)) and starts_with(path, r.p)
         qualify row_number() over (partition by page_id order by length(rule) desc) = 1)
select page_id, host, path, rule, verdict as ruled from p left join fits using (page_id)"""


def op8_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op8(spark, sf_dir)
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 6).alias("base_score"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = cut(trie.sequences(table(spark, sf_dir, "conversations")), "conversations")
    return trie.prefix_trie(trie.with_common_beginnings(made))


# DuckDB has no CRC-32: bytes are folded in, eight shifts each.
CRC32 = "xor(list_reduce([4294967295] || list_transform(string_split({text}, ''), lambda ch: ord(ch)::bigint), lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"

OP12_SQL = f"""
with rows as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
own as (select conv_id, list({{'r': role, 't': text}} order by turn nulls first, role, text) as turns from rows group by conv_id),
heads as (select conv_id, ({CRC32.format(text="conv_id::varchar")} % 6)::bigint as h from own),
built as (
  select o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) as turns
  from own o join heads using (conv_id) left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
members as (select conv_id, d, turns[1:d] as path, len(turns) = d as last from built, unnest(range(0, len(turns) + 1)) as t(d)),
nodes as (
  select path, d, min(conv_id) as conv_id, count(*) as n_convs,
         sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '')) as ends_sha256
  from members group by path, d),
kids as (select path[1:d - 1] as path, d - 1 as d, count(*) as n from nodes where d > 0 group by all),
own_sums as (select n.*, coalesce(k.n, 0) as n_children, case when d = 0 then 0 else (n_convs - 1) * length(path[d].t) end as saved from nodes n left join kids k using (path, d)),
below as (
  select path[1:u] as path, u as d, sum(case when n_children = 0 then 1 else 0 end) as n_leaves, sum(saved) as saved_tokens
  from own_sums, unnest(range(0, d + 1)) as t(u) group by all)
select n.conv_id, n.d as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children, b.n_leaves::bigint as n_leaves, b.saved_tokens::bigint as saved_tokens, n.ends_sha256
from own_sums n join below b using (path, d) left join nodes p on p.d = n.d - 1 and p.path = n.path[1:n.d - 1]"""


OP8_BASE_SQL = f"""
with d as (
  select doc_id, {CRC32.format(text="doc_id::varchar")} % 7 = 2 as held_out,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') || [' end'] as words
  from documents),
t as (select doc_id, held_out, unnest(words) as w from d),
c as (select w, count(*) as c from t where not held_out group by w),
s as (select coalesce(sum(c), 0)::bigint as n, count(*) as v from c)
select doc_id, held_out, count(*) as n_tokens, count(c.c) as n_known, any_value(n) as train_tokens,
       round(sum(log10((coalesce(c.c, 0) + 1) / (n + v + 1)::double)), 6) as base_score
from t left join c using (w), s group by doc_id, held_out"""


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations")), gone=F.col("gone"))


QUERIES = [
    Query("op1_pii", op1),
    Query("op2_exact_dedup", op2, OP2_SQL),
    Query("op3_source_mix", op3),
    Query("op4_syncmer_fingerprints", op4),
    Query("op5_language_id", op5),
    Query("op6_simhash_dedup", op6),
    Query("op7_url_filter", op7),
    Query("op8_lm_score", op8),
    Query("op9_best_fit_packing", op9),
    Query("op10_secret_scan", op10),
    Query("op4_edited_texts", op4_texts, OP4_TEXTS_SQL),
    Query("op7_rules", op7_rules, OP7_RULES_SQL),
    Query("op8_base_scores", op8_base, OP8_BASE_SQL),
    Query("op11_suffix_dedup", op11, OP11_SQL),
    Query("op12_prefix_trie", op12, OP12_SQL),
    Query("op13_structure_repair", op13),
]
