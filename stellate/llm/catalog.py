"""The registered queries of the operators: ``QUERIES[name](spark, sf_dir)`` and ``ORACLE[name]``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import blocknn, bpe, crf, decontam, html_tree, lexical, merkle, minmax, repeats, rules, secrets, toxicity, warc
from stellate.llm.common import lower_ascii, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return keep


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@register("op1_byte_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.ByteBpe(spark, vocabulary())
    ids = codec.encode(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return bpe.digests(codec.decode(ids.drop("text")))


@register("op2_secret_scan")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(docs))

    def count(kind: int):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.as_text("base"), 256).alias("base_sha256"),
        secrets.as_text("spans").alias("spans"),
    )


WORDS_SQL = r"""
d as (select row_number() over () as r, *,
    list_filter(regexp_split_to_array(coalesce({text}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents)"""

NEAR_SQL = f"""
with recursive {WORDS_SQL.format(text="translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")},
sets as (
  select distinct doc_id, array_to_string(w[i : i + 3], ' ') as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as i from d where len(w) > 0)),
sizes as (select doc_id, count(*)::bigint as n from sets group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from sets a join sets b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * c >= 80 * (x.n + y.n - c)),
reached as (
  select distinct a as doc_id, a as other from links
  union
  select doc_id, b from reached join links on other = a),
parts as (select doc_id, min(other) as part from reached group by doc_id)
select doc_id, coalesce(n, 0) as n_shingles, coalesce(part, doc_id) as component_id, coalesce(part, doc_id) = doc_id as kept
from d left join sizes using (doc_id) left join parts using (doc_id)
"""


@register("op5_minmax_near_dedup", NEAR_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax.near_duplicates(read(spark, sf_dir, "documents"))


DECONTAM_SQL = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from documents),
b as (
  select item_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as w from benchmark),
item_windows as (
  select distinct item_id, least(len(w), 13) as n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) as i from b where len(w) > 0)),
sizes as (select distinct n from item_windows),
doc_windows as (
  select doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)),
hits as (
  select doc_id, i, doc_windows.n, item_id from doc_windows
  join item_windows on doc_windows.n = item_windows.n and doc_windows.win = item_windows.win),
covered as (
  select doc_id, count(distinct p) as n_hit
  from (select doc_id, unnest(range(i, i + n)) as p from hits) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as items
  from (select distinct doc_id, item_id::varchar as item_id from hits) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join covered using (doc_id) left join named using (doc_id)
"""


@register("op6_decontaminate", DECONTAM_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontam.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        F.col("n_hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


RULES_SQL = f"""
with {WORDS_SQL.format(text="text")},
windows as (
  select r, i, array_to_string(w[i : i + 4], ' ') as k from (select r, w, unnest(range(1, len(w) - 3)) as i from d where len(w) >= 5)),
again as (select r, k from windows group by r, k having count(*) > 1),
repeated as (
  select r, count(distinct p)::bigint as n_repeat_words
  from (select r, unnest(range(i, i + 5)) as p from windows join again using (r, k)) group by r),
lines as (
  select r, host, text, line, list_filter(regexp_split_to_array(regexp_replace(lower(line), '[0-9]+', '0', 'g'), '{{SPACE}}'),
    lambda x: x <> '') as folded
  from (select r, coalesce(source, 'null') as host, coalesce(text, '') as text, unnest(string_split(coalesce(text, ''), chr(10))) as line from d)),
full_lines as (select *, array_to_string(folded, ' ') as k from lines where len(folded) > 0),
dups as (select r, (count(*) - count(distinct line))::bigint as n_dup_lines from full_lines group by r),
shared as (select host, k from full_lines group by host, k having count(distinct text) > 20),
removed as (select r, sum(len(folded)) as gone from full_lines join shared using (host, k) group by r),
counted as (
  select r, doc_id, len(w)::bigint as n_words, length(regexp_replace(coalesce(text, ''), '{{SPACE}}', '', 'g'))::bigint as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(gone, 0) as gone
  from d left join dups using (r) left join repeated using (r) left join removed using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  not (n_words < 10 or 100 * n_repeat_words > 20 * n_words) and 100 * (n_words - gone) >= 20 * n_words as kept
from counted
""".replace("{SPACE}", r"[\x20\x09-\x0D]+")


@register("op8_quality_rules", RULES_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.judge(read(spark, sf_dir, "documents"))
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *counts, "base_failed", "kept")


REPEATS_SQL = f"""
with {WORDS_SQL.format(text="text")},
windows as (
  select r, i, array_to_string(w[i : i + 34], ' ') as k from (select r, w, unnest(range(1, len(w) - 33)) as i from d where len(w) >= 35)),
again as (select k from windows group by k having count(*) > 1),
gone as (select distinct r, unnest(range(i, i + 35)) as p from windows join again using (k)),
places as (select r, unnest(w) as word, unnest(range(1, len(w) + 1)) as p from d),
kept as (
  select r, string_agg(word, ' ' order by p) as t, count(*)::bigint as n
  from (select * from places anti join gone using (r, p)) group by r)
select doc_id, len(w)::bigint as n_words, len(w)::bigint - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (r)
"""


@register("op3_recompression_dedup", REPEATS_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.remove_repeats(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@register("op4_style_tree_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_tree.main_text(read(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


WARC_SQL = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as x from pages),
f as (select x, payload_bytes, min(page_id) as first from p group by all)
select page_id, p.payload_bytes, array_to_string(list_transform(range(32), lambda i: substr(
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(p.x, (1 + (i // 4) * 5)::int, 5))::int) >> (15 - 5 * (i % 4))::int) & 31), 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from p join f on p.x = f.x and p.payload_bytes = f.payload_bytes
"""


@register("op7_warc_round_trip", WARC_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.round_trip(read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _scored(scored: DataFrame, held_out, threshold: float) -> DataFrame:
    return scored.select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


@register("op9_crf_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crf.fold(F.col("doc_id"), 4) == 2
    labels = read(spark, sf_dir, "labels").where(~held_out)
    return _scored(crf.score(docs, crf.train(docs, labels)), held_out, 0.7)


@register("op10_noisy_channel_toxicity")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crf.fold(F.col("doc_id"), 5) == 0
    labels = read(spark, sf_dir, "labels").where(~held_out)
    return _scored(toxicity.score(docs, toxicity.train(docs, labels)), held_out, 0.5)


def _leaf_sql(text: str) -> str:
    values = [f"cast({c} as varchar)" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return "sha256(" + " || ".join(
        f"case when {v} is null then '-' else octet_length(encode({v})) || ':' || {v} end" for v in values
    ) + ")"


def _siblings_sql(nodes: str, group: str) -> str:
    return f"""select a.{group}, a.k, a.i, coalesce(string_agg(b.h, '' order by b.i) filter (b.i < a.i), '') as before,
    coalesce(string_agg(b.h, '' order by b.i) filter (b.i > a.i), '') as after
  from {nodes} a join {nodes} b on a.{group} is not distinct from b.{group} and a.k = b.k and a.i // 8 = b.i // 8
  group by a.{group}, a.k, a.i"""


MERKLE_SQL = f"""
with recursive crc as (
  select *, xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: ascii(c)::bigint),
    lambda crc, c: list_reduce(range(8), lambda x, j: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, c)),
    4294967295::bigint), 4294967295::bigint) as crc,
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lowered from documents),
rows as (
  select doc_id, lang, {_leaf_sql("text")} as leaf,
    {_leaf_sql("case when crc % 3 = 0 then lowered else text end")} as tampered from crc),
leaves as (
  select row_number() over () as id, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as i,
    doc_id, lang, leaf, tampered from rows),
nodes as (
  select lang, 0 as k, i, leaf as h from leaves
  union all
  select lang, k + 1, i // 8, sha256(string_agg(h, '' order by i))
  from (select *, count(*) over (partition by lang) as c from nodes) where c > 1 group by lang, k, i // 8),
tops as (
  select *, row_number() over (order by lang nulls first) - 1 as place
  from (select lang, max(k) as depth, arg_max(h, k) as subroot from nodes group by lang)),
upper_nodes as (
  select 0 as g, 0 as k, place as i, subroot as h from tops
  union all
  select 0, k + 1, i // 8, sha256(string_agg(h, '' order by i))
  from (select *, count(*) over () as c from upper_nodes) where c > 1 group by k, i // 8),
summit as (select max(k) as height, arg_max(h, k) as root from upper_nodes),
beside as ({_siblings_sql("nodes", "lang")}),
upper_beside as ({_siblings_sql("upper_nodes", "g")}),
steps as (
  select id, b.k, before, after from leaves l join tops t on l.lang is not distinct from t.lang
  join beside b on l.lang is not distinct from b.lang and b.k < t.depth and b.i = l.i // (8 ** b.k)::bigint
  union all
  select id, depth + b.k, before, after from leaves l join tops t on l.lang is not distinct from t.lang
  join upper_beside b on b.i = t.place // (8 ** b.k)::bigint join summit on b.k < height),
folded as (
  select id, 0 as k, tampered as h from leaves
  union all
  select f.id, f.k + 1, sha256(before || h || after) from folded f join steps s on f.id = s.id and f.k = s.k),
ends as (select id, arg_max(h, k) as folded_root from folded group by id),
proofs as (select id, string_agg(before || after, '' order by k) as proof from steps group by id)
select doc_id, leaf, subroot, root, sha256(coalesce(proof, '')) as proof_sha256, folded_root,
  folded_root = root as verified
from leaves l join tops t on l.lang is not distinct from t.lang join ends using (id) left join proofs using (id)
cross join summit
"""


@register("op13_merkle_manifest", MERKLE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    drawn = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    text = F.when(drawn, lower_ascii(F.col("text"))).otherwise(F.col("text"))
    built = merkle.manifest(docs, extra={"tampered": merkle.leaf_digest(*columns, text)})
    return built.proofs().select(
        F.col("key").alias("doc_id"),
        F.col("hash").alias("leaf"),
        "subroot",
        "root",
        F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
        merkle.fold(F.col("tampered"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


LEXICAL_SQL = r"""
with cut as (
  select text, list_filter(regexp_split_to_array(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') as words
  from (select text from documents union select text from benchmark) where text is not null),
d as (select row_number() over () as r, doc_id, words, len(words)::bigint as n from documents join cut using (text) where len(words) > 0),
stats as (select count(*)::bigint as docs, sum(n)::bigint as length from d),
tfs as (select r, t, count(*)::bigint as tf from (select r, unnest(words) as t from d) group by r, t),
dfs as (select t, count(*)::bigint as df from tfs group by t),
asked as (
  select i, item_id, t, count(*)::bigint as times
  from (select i, item_id, unnest(words) as t
    from (select row_number() over () as i, item_id, text from benchmark) join cut using (text))
  group by all),
weighted as (
  select i, item_id, t, times * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::bigint as w
  from asked join dfs using (t), stats),
scored as (
  select i, item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::bigint as score
  from weighted join tfs using (t) join d using (r), stats group by i, item_id, r)
select item_id, row_number() over (partition by i order by score desc, doc_id nulls first)::int as rank, doc_id, score
from scored join d using (r) where score > 0 qualify rank <= 10
"""


@register("op12_shared_lexical_search", LEXICAL_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


NEAREST_SQL = """
with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings
  where embedding is not null and len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
scored as (
  select q.r, q.vec_id as query_id, c.vec_id, c.r as other,
    list_reduce(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]), lambda a, b: a + b, 0::double) as score
  from v q join v c on q.r <> c.r and len(q.e) = len(c.e) where q.vec_id % 20 = 0)
select query_id, row_number() over (partition by r order by score desc, vec_id nulls last, other)::int as rank, vec_id, score
from scored qualify rank <= 20
"""


@register("op11_block_nearest", NEAREST_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return blocknn.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
