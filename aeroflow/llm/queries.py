"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroflow.llm import (
    collocations,
    conversation_trie,
    decontaminate,
    exact_dedup,
    language_id,
    mixing,
    rlz_dedup,
    sharding,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    winnowing,
)
from aeroflow.llm.common import table
from aeroflow.session import prepare

SHINGLE = 4
MAX_BITS = 4


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(prepare(spark), sf_dir, "documents"), shingle=SHINGLE, max_bits=MAX_BITS)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.without_repeats(table(prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.with_running_sums(token_counts.histogram(table(prepare(spark), sf_dir, "documents")))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.scores(docs, model)
    return scored.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"), "n_passages",
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language_id.train(table(prepare(spark), sf_dir, "documents"))
    return language_id.languages_of(table(spark, sf_dir, "pages"), model)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.leaks(docs, benchmark)


def op7_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rlz_dedup.without_repeats(table(prepare(spark), sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mix_plan(table(prepare(spark), sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_rows(table(prepare(spark), sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(prepare(spark), sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversation_trie.sequences(table(prepare(spark), sf_dir, "conversations"))
    return conversation_trie.prefix_trie(conversation_trie.with_shared_heads(found))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.against_next(table(prepare(spark), sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(prepare(spark), sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_decontamination": op6_decontamination,
    "op7_rlz_dedup": op7_rlz_dedup,
    "op8_mixing": op8_mixing,
    "op9_sharding": op9_sharding,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_winnowing": op12_winnowing,
    "op13_collocations": op13_collocations,
}

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLE_SQL = {
    "op8_mixing": rf"""
with docs as (
  select doc_id, source, cast({_WORDS} as bigint) as size,
    cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null') || ':' || coalesce(text, '')), 1, 15) as bigint) as key
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as s,
    case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end as w
  from docs group by source
), filled as (
  select *, sum(s) over (order by 3 * s / w, source nulls last) as upto_s, sum(w) over (order by 3 * s / w, source nulls last) as upto_w,
    sum(s) over () as t, sum(w) over () as all_w
  from sources
), levels as (
  select *, (t - 3 * (upto_s - s)) / (all_w - (upto_w - w)) as level from filled
), level as (
  select max(level) as r from levels  -- it rises up to the last source that is full
), shares as (
  select source, s, least(r * w, 3 * s) as target, cast(floor(least(r * w, 3 * s) + 0.5) as bigint) as budget
  from levels, level
), ordered as (
  select docs.*, s, target, case when s > 0 then budget // s else 0 end as epochs, case when s > 0 then budget % s else 0 end as rest,
    sum(size) over (partition by docs.source order by key) as upto,
    sum(size) over (partition by docs.source, key) as tied
  from docs join shares on docs.source is not distinct from shares.source
)
select doc_id, size, s as source_size, cast(target as double) as target,
  cast(epochs * size + case when upto <= rest then size when upto - tied < rest then size * (rest - (upto - tied)) // tied else 0 end as bigint) as taken,
  source
from ordered""",
    "op10_exact_dedup": r"""
with docs as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as norm from documents
)
select doc_id, min(doc_id) over (partition by norm) as keep_id, count(*) over (partition by norm) as group_size,
  row_number() over (partition by norm order by doc_id nulls last) = 1 as kept, sha256(norm) as text_sha256
from docs""",
    "op11_conversation_trie": """
with turns as (
  select conv_id, list([coalesce(role, ''), coalesce(text, '')] order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as turns
  from conversations where conv_id is not null group by conv_id
), heads as (
  select *, list_reduce(list_concat([4294967295::bigint], list_transform(range(length(cast(conv_id as varchar))), lambda i: ord(substr(cast(conv_id as varchar), cast(i + 1 as bigint), 1))::bigint)),
    lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda i: 0::bigint)), lambda y, z: xor(y >> 1, (y & 1) * 3988292384))) as crc
  from turns
), rebuilt as (
  select c.conv_id, list_concat(coalesce(b.turns, [])[1:cast(xor(c.crc, 4294967295) % 9 as bigint)], c.turns[cast(xor(c.crc, 4294967295) % 9 as bigint) + 1:]) as turns
  from heads c left join turns b on b.conv_id = c.conv_id - c.conv_id % 5
), members as (
  select conv_id, turns, d, turns[1:d] as node from rebuilt, unnest(range(len(turns) + 1)) as u(d)
), nodes as (
  select node, any_value(d) as depth, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (d = len(turns)), '')) as ends_sha256
  from members group by node
), placed as (
  select n.*, p.conv_id as parent_conv_id, (select count(*) from nodes c where c.depth = n.depth + 1 and c.node[1:n.depth] = n.node) as n_children,
    case when n.depth > 0 then (n.n_convs - 1) * strlen(n.node[n.depth][2]) else 0 end as own
  from nodes n left join nodes p on p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]
), below as (
  select b.node[1:d] as node, sum(cast(b.n_children = 0 as bigint)) as n_leaves, sum(b.own) as saved
  from placed b, unnest(range(b.depth + 1)) as u(d) group by 1
)
select p.conv_id, p.depth, p.parent_conv_id, p.n_convs, p.n_children, cast(b.n_leaves as bigint) as n_leaves,
  cast(b.saved as bigint) as saved_tokens, p.ends_sha256
from placed p join below b on p.node = b.node""",
    "op13_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) as piece
  from documents
), words as (
  select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces
), sizes as (
  select lang, cast(sum(len(w)) as bigint) as n from words group by lang
), counts as (
  select lang, w[i:i + m - 1] as p, count(*) as f
  from words, unnest(range(1, 6)) as lengths(m), unnest(range(1, len(w) - m + 2)) as places(i)
  group by all having count(*) >= 100
), cuts as (
  select c.lang, c.p, c.f as a, x.f as l, y.f as r, s.n, (1000::hugeint * c.f * s.n) // (x.f::hugeint * y.f) as score, k
  from counts c join sizes s on c.lang = s.lang, unnest(range(1, len(c.p))) as u(k)
  join counts x on x.lang = c.lang and x.p = c.p[1:k] join counts y on y.lang = c.lang and y.p = c.p[k + 1:]
), worst as (
  select * from cuts qualify row_number() over (partition by lang, p order by score, k) = 1
), within as (
  select lang, p[i:j] as p, max(f) as most from counts, unnest(range(1, len(p) + 1)) as u(i), unnest(range(i, len(p) + 1)) as v(j)
  where j - i + 1 < len(p) group by all
), ranked as (
  select w.lang, row_number() over (partition by w.lang order by w.score desc, w.a desc, array_to_string(w.p, ' ')) as rank,
    array_to_string(w.p, ' ') as phrase, a, l, r, n, cast(score as bigint) as score
  from worst w left join within i on i.lang = w.lang and i.p = w.p
  where i.most is null or 100 * i.most < 100 * w.a
)
select * from ranked where rank <= 2000""",
}
