"""The queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ringtrail.llm import (
    byte_bpe,
    decontaminate,
    exact_dedup,
    language,
    packing,
    prefix_trie,
    quality,
    simhash,
    spelling,
    substring_dedup,
    suffix_array,
    toxicity,
    url_filter,
)
from ringtrail.llm.rows import remainder


#: Texts are of any length, so it takes bytes to bound what is handed to Python at a time.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set(*BATCH)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held(of: str, rest: int):
    """Held out: the id's remainder is `rest`; rows without id are never learned from."""
    return F.coalesce(remainder(F.col("doc_id"), int(of)) == rest, F.lit(True))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = _held("4", 2)
    scored = quality.score(docs, quality.fit(docs, labels, ~held))
    return scored.select(
        "doc_id",
        held.alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "difference",
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.resolve(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = decontaminate.indexes(table(spark, sf_dir, "benchmark"))
    return decontaminate.leaks(table(spark, sf_dir, "documents"), items)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels, ~_held("3", 1))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity_model(docs, labels))
    return scored.select(
        "doc_id",
        _held("3", 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
        "vote",
        "evidence",
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, budget=3)
    return found.select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
    )


def _removed(begin_to_end: str):
    return F.coalesce(
        F.aggregate(begin_to_end, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"]),
        F.lit(0).cast("long"),
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return found.select(
        "doc_id",
        "n_words",
        _removed("spans").alias("n_removed"),
        F.coalesce(F.sha2("kept", 256), "words_sha256").alias("kept_sha256"),
    )


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_array.remove_repeats(table(spark, sf_dir, "documents"), window=100)
    return found.select(
        "doc_id",
        "n_bytes",
        _removed("spans").alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce(F.sha2("kept", 256), "text_sha256").alias("kept_sha256"),
    )


def vocabulary() -> tuple[bytes, str]:
    """Rank file and split pattern of the public tokenizer."""
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        return file.read(), public_tokenizers.PATTERN


def bpe_digests(docs: DataFrame) -> DataFrame:
    ranks, pattern = vocabulary()
    coded = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern), ranks, pattern)
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = _held("5", 0)
    predicted = language.predict(docs, language.fit(docs, ~held))
    return predicted.select("doc_id", held.alias("held_out"), "lang_pred", "score")


RULES = [
    url_filter.Rule("allow", "org/"),
    url_filter.Rule("block", "example.org/es/"),
    url_filter.Rule("block", "example.org/en/1"),
    url_filter.Rule("allow", "com/fr/"),
    url_filter.Rule("block", "com/de/"),
]


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), RULES)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        tokenizer = file.read()
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer, capacity=2048, end_id=0).drop("ids")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.branched_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_toxicity": op4_toxicity,
    "op5_simhash": op5_simhash,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_language": op8_language,
    "op10_suffix_array": op10_suffix_array,
    "op9_url_filter": op9_url_filter,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

_OP2 = r"""
with d as (
  select doc_id, length(coalesce(text, '')) as n,
    sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) as text_sha256
  from documents),
k as (
  select *, row_number() over (partition by text_sha256 order by n desc, doc_id nulls last) as place,
    first_value(doc_id) over (partition by text_sha256 order by n desc, doc_id nulls last) as keep_id,
    count(*) over (partition by text_sha256) as group_size
  from d)
select doc_id, keep_id, group_size, place = 1 as kept, text_sha256 from k
"""


def _op9() -> str:
    """What each round passes on is added up, until nothing that a verdict or a digit could turn on is
    under way."""
    decided, rule = "null", "null"
    for r in sorted(reversed(RULES), key=lambda r: len(r.rule)):
        own, slash, rest = r.rule.partition("/")
        fits = f"(host = '{own}' or ends_with(host, '.{own}')) and starts_with(path, '{slash}{rest}')"
        decided = f"case when {fits} then '{r.verdict}' else {decided} end"
        rule = f"case when {fits} then '{r.rule}' else {rule} end"
    host = "translate(regexp_extract({}, '^[^/?#]*'), '" + url_filter.UPPER + "', '" + url_filter.LOWER + "')"
    link, absolute = url_filter.LINK, url_filter.ABSOLUTE
    return rf"""
with recursive r as (
  select page_id, html,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
  from pages),
h as (
  select page_id, html, {host.format("rest")} as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from r),
p as materialized (select *, {rule} as rule, {decided} as decided from h),
l as (
  select host as src, unnest(regexp_extract_all(html, '{link}', 1)) as link from p),
e as (
  select src, {host.format("substr(link, instr(link, '//') + 2)")} as dst from l
  where regexp_matches(link, '{absolute}')),
n as (select src, dst, count(*) as n from e where src <> '' and dst <> '' and src <> dst group by all),
b as (
  select 'trust' as kind, src, dst, n from n union all
  select 'distrust', dst, src, n from n),
ways as materialized (
  select kind, src, dst, 0.85::double * n / sum(n) over (partition by kind, src) as part from b),
g as (
  select host as src, avg(case when decided = 'allow' then 1.0::double else 0 end) as trust,
    avg(case when decided = 'block' then 1.0::double else 0 end) as distrust
  from p where host <> '' group by host),
s0 as materialized (
  select 'trust' as kind, src, trust as score from g where trust > 0 union all
  select 'distrust', src, distrust from g where distrust > 0),
rounds as (
  select 0 as n, kind, src, score from s0 union all
  select max(r.n) + 1, w.kind, w.dst, sum(r.score * w.part)
  from rounds r join ways w on w.kind = r.kind and w.src = r.src where r.score > 1e-15 group by w.kind, w.dst),
f as (
  select src as host, round(sum(case when kind = 'trust' then score else 0 end), 6) as trust,
    round(sum(case when kind = 'distrust' then score else 0 end), 6) as distrust
  from rounds group by src)
select page_id, p.host, path, rule,
  coalesce(decided, case when coalesce(distrust, 0) >= 0.05 and distrust > trust then 'block'
    else 'allow' end) as verdict,
  coalesce(trust, 0.0::double) as trust, coalesce(distrust, 0.0::double) as distrust
from p left join f on f.host = p.host
"""


_OP6 = r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as words
  from documents),
p as (
  select doc_id, words, unnest(range(len(words) - 12)) as place from d where len(words) >= 13),
w as (
  select doc_id, place, md5(array_to_string(words[place + 1:place + 13], ' ')) as hash from p),
f as (select hash, min(doc_id) as first from w group by hash having min(doc_id) < max(doc_id)),
c as (
  select distinct doc_id, unnest(range(place, place + 13)) as i
  from w join f using (hash) where doc_id > first),
g as (select doc_id, list(i) as gone from c group by doc_id),
k as (
  select doc_id, len(words) as n_words, coalesce(len(gone), 0) as n_removed,
    case when gone is null then words else list_filter(words, lambda w, i: not list_contains(gone, i - 1)) end
      as kept
  from d left join g using (doc_id))
select doc_id, n_words, n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) as kept_sha256 from k
"""

_OP10 = r"""
with d as (
  select doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n from documents),
w as (
  select doc_id, place, md5(substr(h, 2 * place + 1, 200)) as hash
  from (select doc_id, h, unnest(range(n - 99)) as place from d where n >= 100)),
f as (
  select doc_id, place, (doc_id, place) as here, min((doc_id, place)) over (partition by hash) as first
  from w),
s as (
  select doc_id, place, place - lag(place) over (partition by doc_id order by place) as step
  from f where here <> first),
g as (
  select doc_id, place, sum(case when step <= 100 then 0 else 1 end)
    over (partition by doc_id order by place) as run
  from s),
r as (
  select doc_id, min(place) as b, max(place) + 100 as e,
    lag(max(place) + 100, 1, 0) over (partition by doc_id order by min(place)) as before
  from g group by doc_id, run),
k as (
  select doc_id, sum(e - b) as n_removed, count(*) as n_spans, max(e) as past,
    string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' order by b) as head, any_value(h) as h
  from r join d using (doc_id) group by doc_id)
select doc_id, d.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
  sha256(unhex(case when k.h is null then d.h else head || substr(k.h, 2 * past + 1) end)) as kept_sha256
from d left join k using (doc_id)
"""

# crc32 byte by byte, with the table that its polynomial gives.
_CRC_TABLE = """
tab as materialized (
  select list(list_reduce(list_prepend(i::ubigint, range(8)::ubigint[]),
    lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384::ubigint) else c >> 1 end) order by i) as t
  from range(256) r(i))"""


def _crc32(text: str) -> str:
    """SQL for the crc32 of a text's UTF-8; `t` is the table."""
    digits = f"hex(encode({text}))"
    code = f"list_transform(range(0, length({digits}), 2), lambda i: ('0x' || substr({digits}, i + 1, 2))::ubigint)"
    return (
        f"xor(list_reduce(list_prepend(4294967295::ubigint, {code}),"
        " lambda c, b: xor(c >> 8, t[(xor(c, b) & 255)::bigint + 1])), 4294967295::ubigint)"
    )


_OP11 = rf"""
with recursive {_CRC_TABLE},
d as (
  select doc_id, unnest(regexp_extract_all(
    translate(coalesce(text, ''), '{spelling.UPPER}', '{spelling.LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) as run
  from documents),
o as (select doc_id, run, count(*) as times from d group by all),
h as (
  select run, times, {_crc32("coalesce(doc_id::varchar, '') || ':' || run")} as h from o, tab),
w as (
  select case when h % 199 = 0 then substr(run, 1, (h % length(run))::int)
    || substr(run, (h % length(run))::int + 2) else run end as word, times
  from h),
v as materialized (
  select word, sum(times)::bigint as n from w where length(word) >= 6 group by word having sum(times) >= 5),
x as materialized (
  select word, n, i, substr(word, 1, i - 1) as head, substr(word, i + 1) as tail
  from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
near as (
  select a.word, b.word as near, b.n as m from x a join x b
    on a.i = b.i and a.head = b.head and a.tail = b.tail and a.word <> b.word union
  select x.word, v.word, v.n from x join v on v.word = head || tail union
  select v.word, x.word, x.n from x join v on v.word = head || tail),
best as (
  select word, count(*) as n_near, first(near order by m desc, near) as near, max(m) as m from near group by word),
f as materialized (
  select word, n, coalesce(n_near, 0) as n_near, case when m >= 5 * n then near end as form,
    case when m >= 5 * n then m end as form_n
  from v left join best using (word)),
up as (
  select word, word as root from f union
  select up.word, f.form from up join f on f.word = up.root where f.form is not null)
select word, f.form, up.root, f.n, f.n_near, f.form_n
from f join up using (word) join f l on l.word = up.root where l.form is null
"""

_OP13 = f"""
with {_CRC_TABLE},
turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
    partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) - 1 as place
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, {_crc32("conv_id::varchar")} % 6 as h
  from (select distinct conv_id from turns), tab),
rebuilt as (
  select c.conv_id, 0 as own, place, role, text from convs c join turns t on t.conv_id = c.base and place < h
  union all
  select conv_id, 1, place, role, text from convs join turns using (conv_id) where place >= h),
steps as (
  select conv_id, length(text) as size, row_number() over p as depth, count(*) over (partition by conv_id) as total,
    sha256(role || chr(1) || text) as mark
  from rebuilt window p as (partition by conv_id order by own, place)),
paths as (
  select conv_id, depth, total, size,
    md5(string_agg(mark, '' order by depth) over (partition by conv_id order by depth)) as name,
    md5(string_agg(mark, '' order by depth) over (partition by conv_id order by depth
      rows between unbounded preceding and 1 preceding)) as above
  from steps
  union all select conv_id, 0, coalesce(total, 0), 0, 'root', null
  from convs left join (select conv_id, any_value(total) as total from steps group by conv_id) using (conv_id)),
named as materialized (
  select conv_id, depth, total, size, name, case when depth = 1 then 'root' else above end as above from paths),
nodes as materialized (
  select depth, name, any_value(above) as above, min(conv_id) as owner, count(*) as n_convs, any_value(size) as size,
    count(*) filter (depth = total) as n_ends,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (depth = total), '')) as ends_sha256
  from named group by depth, name),
under as (
  select a.depth, a.name, sum(case when n.n_ends = n.n_convs then 1 else 0 end)::bigint as n_leaves,
    sum((n.n_convs - 1) * n.size)::bigint as saved_tokens
  from nodes n join named p on p.conv_id = n.owner and p.depth <= n.depth
    join nodes a on a.depth = p.depth and a.name = p.name
  group by a.depth, a.name),
children as (select depth - 1 as depth, above as name, count(*) as n_children from nodes where depth > 0 group by all)
select n.owner as conv_id, n.depth, p.owner as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children,
  n_leaves, saved_tokens, n.ends_sha256
from nodes n join under u on u.depth = n.depth and u.name = n.name
  left join nodes p on p.depth = n.depth - 1 and p.name = n.above
  left join children c on c.depth = n.depth and c.name = n.name
"""

ORACLES: dict[str, str] = {"op11_spelling_variants": _OP11, "op13_prefix_trie": _OP13, "op10_suffix_array": _OP10, "op6_substring_dedup": _OP6, "op2_exact_dedup": _OP2, "op9_url_filter": _op9()}
