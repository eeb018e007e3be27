"""Registered queries of the corpus operators, and the same queries as DuckDB SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendloom.llm import audit, embeddings, licences, mixing, packing, positional, quality, resampling, sharding, simhash, tokens, toxicity
from lendloom.llm.common import read_table

TOKENIZER = "byte_bpe_50k.json"
#: Scores from here on count as toxic.
TOXIC = 0.3


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.with_verdict(docs).select("doc_id", *(f"quality.{n}" for n in (*quality.BASE, "base_failed", "kept")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.with_score(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_online(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(read_table(spark, sf_dir, "documents"))


def op6_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = packing.pack_matrices(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return rows.withColumn("ids_crc32", F.crc32("ids"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(read_table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", simhash.hex_digits().alias("fingerprint"), "component_id")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = tokens.count_tokens(docs, public_tokenizers.path(TOKENIZER))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit_filters(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_embedding_near_dedup, op2_quality_rules, op3_toxicity, op4_packing, op5_sharding, op6_token_matrices, op7_mixing, op8_licence_scan, op9_simhash_near_dedup, op10_token_counts, op11_filter_audit, op12_decontamination, op13_importance_resampling)}

OP1 = """
with recursive e as (select row_number() over () as r, vec_id, embedding::double[] as v,
    embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0 as ok from embeddings),
link as (select a.r as x, b.r as y from e a join e b on a.r <> b.r and a.ok and b.ok and len(a.v) = len(b.v) where case when a.ok and b.ok and len(a.v) = len(b.v) then list_cosine_similarity(a.v, b.v) >= 0.95 end),
reach as (select r as x, r as y from e union select reach.x, link.y from reach join link on reach.y = link.x),
least as (select x, min(vec_id) as component_id from reach join e on e.r = reach.y group by x),
n as (select x, count(*) as n_links from link group by x)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, coalesce(vec_id = component_id, true) as kept from e join least on least.x = e.r left join n on n.x = e.r
"""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP2 = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as text, {WORDS} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
w as (select r, unnest(words) as word, generate_subscripts(words, 1) as pos from d),
five as (select r, pos, word, word = lag(word) over o as stutter,
    case when lead(word, 4) over o is not null then [word, lead(word) over o, lead(word, 2) over o, lead(word, 3) over o, lead(word, 4) over o] end as five
    from w window o as (partition by r order by pos)),
found as (select r, pos, stutter, (five is not null and count(*) over (partition by r, five) > 1)::int as again from five),
covered as (select r, stutter, max(again) over (partition by r order by pos rows between 4 preceding and current row) as again from found),
sums as (select r, sum(again)::bigint as n_repeat_words, count(*) filter (where stutter) as n_stutter from covered group by r),
top as (select r, max(n) as n_top_word from (select r, word, count(*) as n from w group by r, word) group by r),
base as (select doc_id, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(n_stutter, 0) as n_stutter, coalesce(n_top_word, 0) as n_top_word,
    len(list_filter(words, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) as n_letter_words,
    len(list_filter(lines, lambda x: regexp_matches(x, '([.][.][.]|…)[\x20\x09-\x0D]*$'))) as n_cut_lines, len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*([-*]\x20|•)'))) as n_bullet_lines
    from d left join sums using (r) left join top using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
    not (n_words < 10 or 100 * n_repeat_words > 20 * n_words or 10 * n_symbols > n_words or 5 * n_stutter > n_words or 2 * n_dup_lines > n_lines
        or word_chars < 2 * n_words or word_chars > 100 * n_words or 10 * n_top_word > 4 * n_words or 2 * n_letter_words < n_words
        or 10 * n_cut_lines > 3 * n_lines or (n_lines > 1 and 10 * n_bullet_lines > 9 * n_lines)) as kept
from base
"""

OP7 = rf"""
with d as (select doc_id, source, len({WORDS})::bigint as size, md5(concat_ws('-', '{mixing.SEED}', doc_id::varchar, md5(coalesce(text, '')))) as h from documents),
s as (select source, sum(size)::bigint as source_size, row_number() over (order by source is null, source) as rank from d group by source),
t as (select *, [3, 1, 2][((rank - 1) % 3 + 1)::int] as weight, source_size * 2 as most from s),
u as (select *, most / weight::double as limit_level,
    (sum(source_size) over () * 1.5::double - coalesce(sum(most) over e, 0)) / (sum(weight) over () - coalesce(sum(weight) over e, 0))::double as level
    from t window e as (order by most / weight::double, rank rows between unbounded preceding and 1 preceding)),
f as (select level from u where level <= limit_level order by limit_level, rank limit 1),
g as (select source, source_size, rank, least(coalesce((select level from f), 0.0) * weight, most::double) as target from t),
w as (select d.*, g.source_size, g.target, sum(size) over (partition by g.rank order by h, doc_id, size rows between unbounded preceding and current row)::bigint as words
    from d join g on d.source is not distinct from g.source),
c as (select *, case when target > 0 and size > 0 then words / target end as f0, case when target > 0 and size > 0 then (words + source_size) / target end as f1 from w),
times as (select finish, sum(sum(size)) over (order by finish) as until from (select f0 as finish, size from c union all select f1, size from c) where finish is not null group by finish),
cut as (select max(finish) as cut from times where until <= (select sum(size) * 1.5::double from d))
select doc_id, size, source_size, target, (size * (coalesce((f0 <= cut)::int, 0) + coalesce((f1 <= cut)::int, 0)))::bigint as taken from c, cut
"""

#: licence texts, notices, patterns and spellings come from the operator's own tables
_CANON = "lower(coalesce({x}, ''))"
for _pattern, _by in (*((a, b.replace("$", "\\")) for a, b in licences.COPYRIGHT), (licences.LIST_MARK, ""), (licences.NOT_WORD, " "), *((rf"\b{a}\b", b) for a, b in licences.SPELLINGS)):
    _CANON = "regexp_replace(" + _CANON + ", '" + _pattern.replace("{", "{{").replace("}", "}}") + f"', '{_by}', 'g')"


def _rows(texts: tuple[tuple[str, str], ...]) -> str:
    return ", ".join("('{}', '{}')".format(a, b.replace("'", "''")) for a, b in texts)


_JOINED = r"trim(regexp_replace({x}, '[ \n]+', ' ', 'g'))"
_BLOCKS = "list_filter(list_transform(regexp_split_to_array(lines, '\\n *\\n[ \\n]*'), lambda b: " + _JOINED.format(x="b") + "), lambda b: b <> '')"
_BARE = f"case when len(blocks) > 1 and len(string_split(blocks[1], ' ')) <= {licences.HEADING} then blocks[2:] else blocks end"
OP8 = f"""
with texts as (select licence, {_BLOCKS} as blocks, notice from (select licence, {_CANON.format(x="text")} as lines, notice from (select licence, text, true as notice from (values {_rows(licences.NOTICES)}) v(licence, text) union all select licence, text, false from (values {_rows(licences.published_texts())}) v(licence, text)))),
known as (select licence, notice, md5(array_to_string(blocks, ' ')) as whole, md5(array_to_string({_BARE}, ' ')) as bare, list_transform({_BARE}, lambda b: md5(b)) as blocks from texts),
digests as (select digest, min(licence) as licence from (select licence, whole as digest from known union all select licence, bare from known) group by digest),
notices as (select bare as digest, min(licence) as licence from known where notice group by bare),
l as (select row_number() over () as r, doc_id, {_CANON.format(x="text")} as lines from documents),
d as (select *, {_BLOCKS} as blocks from l),
h as (select r, doc_id, md5(array_to_string(blocks, ' ')) as text_digest, md5(array_to_string({_BARE}, ' ')) as bare, list_transform(blocks, lambda b: md5(b)) as blocks from d),
in_lines as (select r, count(*) as n, string_agg(distinct licence, ',' order by licence) as names from (select r, md5(trim(unnest(string_split(lines, chr(10))))) as digest from l) join notices using (digest) group by r),
in_blocks as (select r, string_agg(distinct licence, ',' order by licence) as names from (select r, licence from (select r, unnest(blocks) as digest from h) join notices using (digest)
    union all select r, licence from h join known on not notice and list_has_all(h.blocks, known.blocks)) group by r)
select doc_id, text_digest, coalesce(a.licence, b.licence) as text_licence, coalesce(n, 0)::bigint as n_licence_lines, coalesce(in_lines.names, '') as line_licences, coalesce(in_blocks.names, '') as block_licences
from h left join in_lines using (r) left join in_blocks using (r) left join digests a on a.digest = text_digest left join digests b on b.digest = bare
"""

OP11 = rf"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as text, {WORDS} as words from documents),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
f as (select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, case when len(words) < 200 then 'A' else '' end
    || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
    || case when 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) then 'C' else '' end
    || case when regexp_matches(text, '[#$%&*|]') then 'D' else '' end
    || case when doc_id > min(doc_id) over (partition by text) then 'E' else '' end as fails from d left join l using (doc_id)),
m as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from f group by part, fails),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (select a.x || b.x || c.x || d.x || e.x as filter_order from letters a, letters b, letters c, letters d, letters e where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps as (select filter_order, step, filter_order[step:step] as letter, filter_order[1:step - 1] as earlier from orders, (select unnest([1, 2, 3, 4, 5]) as step)),
r as (select part, filter_order, step, letter, translate(fails, earlier, '') = fails as there, contains(fails, letter) as hit, fails, n, good, toxic from steps, m),
s as (select part, filter_order, step, letter, sum(case when there and not hit then n else 0 end)::bigint as kept, sum(case when there and hit then n else 0 end)::bigint as removed,
    sum(case when hit and not there then n else 0 end)::bigint as redundant, sum(case when fails = letter then n else 0 end)::bigint as unique_fails,
    sum(case when there and hit then good else 0 end)::bigint as good_lost, sum(case when there and hit then toxic else 0 end)::bigint as toxic_lost from r group by part, filter_order, step, letter)
select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, letter))::bigint as shapley from s
"""

LOWER_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = rf"""
with d as (select row_number() over () as r, doc_id, {LOWER_WORDS} as words from documents),
i as (select item_id, {LOWER_WORDS} as words from benchmark),
windows as (select distinct item_id, least(len(words), {positional.WINDOW}) as size, list_slice(words, k, k + least(len(words), {positional.WINDOW}) - 1) as w
    from (select *, unnest(range(1, greatest(len(words) - {positional.WINDOW} + 1, 1) + 1)) as k from i where len(words) > 0)),
spots as (select r, size, k, list_slice(words, k, k + size - 1) as w from (select r, words, size, unnest(range(1, len(words) - size + 2)) as k from d, (select distinct size from windows))),
hits as (select r, item_id, k, size from spots join windows using (size, w)),
hit_words as (select r, count(distinct k + o) as n_hit from (select r, k, unnest(range(size)) as o from hits) group by r),
found as (select r, count(*) as n_items, string_agg(item_id::varchar, ',' order by item_id::varchar) as items from (select distinct r, item_id from hits where item_id is not null) group by r)
select doc_id, len(words)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hit_words using (r) left join found using (r)
"""

#: CRC-32 bit by bit: eight steps of this for each byte
_STEP = "case when {x} & 1 = 1 then xor({x} >> 1, 3988292384) else {x} >> 1 end"
OP13 = rf"""
with recursive d as (select row_number() over () as r, doc_id, {LOWER_WORDS} as words from documents),
i as (select unnest({LOWER_WORDS}) as word from benchmark),
w as (select r, unnest(words) as word from d),
bits as (select n as byte, n::bigint as crc, 0 as k from range(256) t(n) union all select byte, {_STEP.format(x="crc")}, k + 1 from bits where k < 8),
crcs as (select list(crc order by byte) as crcs from bits where k = 8),
vocabulary as (select word, hex(encode(word)) as x from (select word from w union select word from i)),
buckets as (select word, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, len(x), 2), lambda p: ('0x' || x[p:p + 1])::bigint)),
    lambda c, b: xor(crcs[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {resampling.BUCKETS} as bucket from vocabulary, crcs),
s as (select bucket, count(*) as s from w join buckets using (word) group by bucket),
t as (select bucket, count(*) as t from i join buckets using (word) group by bucket),
gains as (select bucket, floor(1000 * ln((coalesce(t, 0)::double + 1) * ((select count(*) from w)::double + {resampling.BUCKETS}) / ((coalesce(s, 0)::double + 1) * ((select count(*) from i)::double + {resampling.BUCKETS}))))::bigint as gain from s full join t using (bucket)),
sums as (select r, sum(gain)::bigint as total from w join buckets using (word) join gains using (bucket) group by r),
weighed as (select r, doc_id, len(words)::bigint as n, case when len(words) = 0 then 0 else (total - ((total % len(words)) + len(words)) % len(words)) // len(words) end::bigint as weight from d left join sums using (r)),
scored as (select *, (weight + floor(-1000 * ln(-ln((('0x' || sha256('{resampling.SEED}:' || coalesce(doc_id::varchar, ''))[1:8])::bigint::double + 0.5) / 4294967296))))::bigint as score from weighed),
ranked as (select r, row_number() over (order by score desc, doc_id nulls last, n) as rank from scored where n >= {resampling.LEAST_WORDS})
select doc_id, n as n_features, weight, score, case when rank <= (select count(*) from ranked) * {resampling.PERCENT} // 100 then rank end as rank from scored left join ranked using (r)
"""

ORACLE_SQL = {"op1_embedding_near_dedup": OP1, "op2_quality_rules": OP2, "op7_mixing": OP7, "op8_licence_scan": OP8, "op11_filter_audit": OP11, "op12_decontamination": OP12, "op13_importance_resampling": OP13}
