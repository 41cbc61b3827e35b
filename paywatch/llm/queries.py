"""Registered queries of the text operators and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paywatch.llm import (
    conversation_trie,
    decontaminate,
    license_scan,
    lm_score,
    merkle,
    packing,
    phrases,
    quality,
    repeats,
    secret_scan,
    sentence_pieces,
    simhash,
    token_codes,
)
from paywatch.llm.common import read_documents, stage_path, training_bucket

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        REGISTRY[query.__name__] = query
        if sql:
            ORACLE[query.__name__] = sql
        return query

    return add


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@register()
def op1_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "codes")
    token_codes.write(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), path)
    return token_codes.documents(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@register()
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.licenses(read_documents(spark, sf_dir))
    joined = (F.array_join(c, ",").alias(c) for c in ("base_labels", "labels"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", *joined, "score")


@register()
def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    scored = quality.scores(docs, quality.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(
        "doc_id",
        (training_bucket(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= quality.KEEP_FROM).cast("int").alias("predicted"),
    )


@register()
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_documents(spark, sf_dir))


@register()
def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.fingerprints(read_documents(spark, sf_dir))


@register()
def op6_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
SHINGLES = (
    "select distinct {key}, unnest(case when len(w) >= 5 then [array_to_string(w[i : i + 4], ' ') for i in range(1, len(w) - 3)]"
    " when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as s from (select {key}, {words} as w from {table})"
)


@register(f"""
with d as ({SHINGLES.format(key="doc_id", words=WORDS, table="documents")}),
i as ({SHINGLES.format(key="item_id", words=WORDS, table="benchmark")}),
n as (select item_id, count(*) as n_item from i group by item_id),
c as (select doc_id, item_id, count(*) as n_shared from d join i using (s) group by doc_id, item_id)
select doc_id, item_id, n_item, n_shared, n_shared / n_item as containment from c join n using (item_id)
where n_shared >= ceil(n_item * 0.8 - 1e-9)
""")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@register()
def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_passages(read_documents(spark, sf_dir))


@register()
def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(read_documents(spark, sf_dir))


def _secret_spans(kind: str, pattern: str, least: int = 0, group: int = 0) -> str:
    """One row per match: its start is the length of all matches and gaps before it."""
    return f"""select doc_id, '{kind}' as kind, len(unnest(g[1 : len(m)])) as gap, len(unnest(m)) as n, len(unnest(v)) as nv, unnest(range(len(m))) as i,
{least} as least from (select doc_id, regexp_extract_all(t, '{pattern}', 0) as m, regexp_extract_all(t, '{pattern}', {group}) as v,
string_split_regex(t, '{pattern}') as g from (select doc_id, coalesce(text, '') as t from documents) where regexp_matches(t, '{pattern}'))"""


SECRET_RANKS = ", ".join(f"'{r.kind}'" for r in secret_scan.RULES)
SECRET_SQL = f"""
with m as ({" union all ".join(_secret_spans(r.kind, r.pattern.replace("'", "''"), r.least, r.group) for r in secret_scan.RULES)}),
p as (select *, sum(gap + n) over (partition by doc_id, kind order by i) as stop from m),
s as (select doc_id, kind, stop - n as start, kind || ':' || (stop - n)::bigint || ':' || stop::bigint as line,
list_position([{SECRET_RANKS}], kind) as rank from p where nv >= least),
g as (select doc_id, count(*) filter (rank = 1) as n_assign, count(*) filter (rank = 2) as n_access, count(*) filter (rank = 3) as n_hex,
string_agg(line, ',' order by start, rank) filter (rank <= 3) as base, string_agg(line, ',' order by start, rank) as spans from s group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from documents d left join g using (doc_id)
"""


@register(SECRET_SQL)
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.find_secrets(read_documents(spark, sf_dir), secret_scan.new_ledger(spark))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    base = [r.kind for r in secret_scan.BASE_RULES]
    return found.select(
        "doc_id",
        *(F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in base),
        F.sha2(secret_scan.listing(of(*base)).cast("binary"), 256).alias("base_sha256"),
        secret_scan.listing(F.col("spans")).alias("spans"),
    )


@register()
def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentence_pieces.encode(read_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
        "agrees",
    )


def _crc32(string: str) -> str:
    """Unsigned CRC-32 of an ASCII string, bit by bit."""
    bit = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    step = f"list_reduce([xor(r, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: {bit})"
    codes = f"list_transform(string_split({string}, ''), lambda s: ascii(s)::bigint)"
    return f"xor(list_reduce([4294967295] || {codes}, lambda r, b: {step}), 4294967295)"


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::varchar) || ':' || {c}::varchar, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


def _merkle_levels(name: str, nodes: str) -> str:
    return f"""{name} as ({nodes} union all
select grp, lvl + 1, pos // 3, sha256(string_agg(d, '' order by pos)), (n + 2) // 3 from {name} where n > 1 group by grp, lvl, pos // 3, n)"""


@register(f"""
with recursive base as (select doc_id, source, {_leaf("text")} as leaf,
case when {_crc32("doc_id::varchar")} % 2 = 0 then {_leaf("replace(text, chr(10), '')")} else {_leaf("text")} end as told from documents),
ranked as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from base),
{_merkle_levels("low", "select source as grp, 0 as lvl, pos, leaf as d, n from ranked")},
sub as (select grp as source, d as subroot, lvl as height, row_number() over (order by grp nulls first) - 1 as place, count(*) over () as n from low where n = 1),
{_merkle_levels("top", "select 0 as grp, 0 as lvl, place as pos, subroot as d, n from sub")},
node as (select place as tree, lvl, pos, d from low join sub on grp is not distinct from source union all select -1, lvl, pos, d from top),
way as (select doc_id, leaf, told, subroot, pos, place, height, unnest(range(height + (select max(lvl) from top))) as step
from ranked join sub on ranked.source is not distinct from sub.source),
step as (select *, case when step < height then pos // (3 ** step)::bigint else place // (3 ** (step - height))::bigint end as spot,
case when step < height then place else -1 end as tree, case when step < height then step else step - height end as lvl from way),
side as (select step.doc_id, step.leaf, step.step, coalesce(string_agg(node.d, '' order by node.pos) filter (node.pos < spot), '') as l,
coalesce(string_agg(node.d, '' order by node.pos) filter (node.pos > spot), '') as r
from step join node on node.tree = step.tree and node.lvl = step.lvl and node.pos // 3 = spot // 3 group by all),
path as (select doc_id, leaf, string_agg(l || r, '' order by step) as proof, list(l || '|' || r order by step) as steps from side group by all),
done as (select ranked.doc_id, ranked.leaf, subroot, (select d from top where n = 1) as root, sha256(coalesce(proof, '')) as proof_sha256,
list_reduce([told] || coalesce(steps, []), lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) as folded_root
from ranked join sub on ranked.source is not distinct from sub.source left join path on path.doc_id is not distinct from ranked.doc_id and path.leaf = ranked.leaf)
select *, folded_root = root as verified from done
""")
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 2 == 0
    told = F.when(even & F.col("text").contains("\n"), merkle.leaf(F.replace(F.col("text"), F.lit("\n"), F.lit(""))))
    proofs = merkle.manifest(read_documents(spark, sf_dir), {"told": told}).proofs()
    folded = merkle.fold(F.coalesce("told", "leaf"), F.col("path"))
    out = proofs.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


@register(f"""
with t as (select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) as j,
struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) as turn from conversations where conv_id is not null),
c as (select c, count(*) as n, {_crc32("c::varchar")} % 9 as h from t group by c),
s as (select c.c, n, h, (select count(*) from t where t.c = c.c - c.c % 5 and t.j <= h) as hb from c),
m as (select s.c, t.j as d, turn from s join t on t.c = s.c - s.c % 5 and t.j <= h
union all select s.c, hb + t.j - h, turn from s join t on t.c = s.c and t.j > h),
p as (select c, 0::bigint as d, [] as prefix, 0 as nb from s
union all select c, d, list(turn) over (partition by c order by d), strlen(turn.text) from m),
e as (select p.*, d = hb + greatest(n - h, 0) as ends from p join s using (c)),
v as (select d as depth, prefix, min(c) as conv_id, count(*) as n_convs, any_value(nb) as nb,
sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256 from e group by all),
k as (select child.depth - 1 as depth, prefix[1 : child.depth - 1] as prefix, count(*) as n_children from v child where child.depth > 0 group by all),
u as (select v.*, coalesce(n_children, 0) as n_children from v left join k on k.depth = v.depth and k.prefix = v.prefix),
a as (select prefix, depth, n_children, (n_convs - 1) * nb as saved, unnest(range(depth + 1)) as up from u),
b as (select up as depth, prefix[1 : up] as prefix, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens from a group by all)
select u.conv_id, u.depth, x.conv_id as parent_conv_id, u.n_convs, u.n_children, n_leaves, saved_tokens, u.ends_sha256
from u join b on b.depth = u.depth and b.prefix = u.prefix left join v x on x.depth = u.depth - 1 and x.prefix = u.prefix[1 : u.depth - 1]
""")
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
