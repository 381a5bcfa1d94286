"""The operators' queries over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm.common import read_table
from tillroll.llm.decontaminate import contained_items
from tillroll.llm.exact_dedup import exact_dedup
from tillroll.llm.language_id import language_ids
from tillroll.llm.lexical_search import lexical_search
from tillroll.llm.lm_score import lm_scores
from tillroll.llm.mixing import with_copies
from tillroll.llm.periodic_runs import most_repeated, periodic_runs
from tillroll.llm.sharding import resharded_store
from tillroll.llm.simhash import simhash_components
from tillroll.llm.substring_dedup import substring_dedup
from tillroll.llm.suffix_dedup import suffix_dedup
from tillroll.llm.token_counts import token_counts
from tillroll.llm.toxicity import toxicity_scores

#: Of the mixing query and stage: relative weights, other nodes weigh 1.
MIX_WEIGHTS = {("d0",): 3, ("d1",): 2, ("d0", "en"): 4, ("d1", "en"): 3, ("d2", "en"): 3, ("d3", "en"): 2}
MIX = {"weights": MIX_WEIGHTS, "share": 0.75, "max_epochs": 2, "seed": 13}
TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def domain_of(source: str = "source") -> Column:
    """Four domains: the number at the end of a source's name modulo 4."""
    digits = F.regexp_extract(F.coalesce(F.col(source), F.lit("")), "([0-9]{1,4})$", 1)
    return F.concat(F.lit("d"), (F.when(digits == "", "0").otherwise(digits).cast("int") % 4).cast("string"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, read_table(spark, sf_dir, "labels"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"), batches=2)


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_ids(read_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_copies(read_table(spark, sf_dir, "documents"), domain_of(), **MIX)
    return rows.select(
        "doc_id", F.col("__domain").alias("domain"), F.col("__lang").alias("lang"), F.col("__source").alias("source"),
        F.col("__tokens").alias("n_tokens"), F.col("__copies").alias("copies"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resharded_store(read_table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup(read_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256")


def repeated_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words that op12's contract looks at: a tenth of the documents get a tail that
    repeats one of their stretches; rows with a null id stay as they are."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(read_table(spark, sf_dir, "documents"), rewrite=repeated_tail)
    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    best = most_repeated()
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.call_function("div", F.lit(1000) * best["length"], best["period"]).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_exact_dedup, op3_lm_score, op4_token_counts, op5_language_id, op6_mixing,
        op7_decontamination, op8_sharding, op9_substring_dedup, op10_simhash_dedup,
        op11_suffix_dedup, op12_periodic_runs, op13_lexical_search,
    )
}

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
# Lower case in A-Z only, as DuckDB's lower() changes other letters too.
_LOWER_WORDS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+')"
)

# Terms of the search: ASCII letters and digits and everything beyond ASCII.
_TERMS = (
    r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)


def _level(depth: int) -> str:
    """The water filling of one level of the mixing tree."""
    path = ("domain", "lang", "source")[:depth]
    keys, parent = ", ".join(path), ", ".join(path[:-1]) or "0"
    given = " ".join(
        "when " + " and ".join(f"{c} = '{v}'" for c, v in zip(path, k, strict=True)) + f" then {w}"
        for k, w in MIX_WEIGHTS.items()
        if len(k) == depth
    )
    weight = f"case {given} else 1 end" if given else "1"
    budget = "(select b from total)" if depth == 1 else "p.budget"
    up = f"join b{depth - 1} p using ({', '.join(path[:-1])})" if depth > 1 else ""
    return f"""
n{depth} as (select {keys}, cast(sum(tokens) * {MIX["max_epochs"]} as bigint) as supply from leaves group by {keys}),
w{depth} as (select {keys}, supply, {weight} as weight, {budget} as allowed from n{depth} {up}),
r{depth} as (select *, supply / cast(weight as double) as ratio from w{depth}),
s{depth} as (select *,
  sum(supply) over (partition by {parent} order by ratio, {path[-1]} rows unbounded preceding) as so_far,
  sum(weight) over (partition by {parent}) - sum(weight) over (partition by {parent} order by ratio, {path[-1]} rows unbounded preceding) as rest
  from r{depth}),
f{depth} as (select *, so_far + ratio * rest <= allowed as is_full from s{depth}),
o{depth} as (select *,
  allowed - sum(case when is_full then supply else 0 end) over (partition by {parent}) as remaining,
  sum(case when is_full then 0 else weight end) over (partition by {parent}) as open_weight from f{depth}),
b{depth} as (select {keys}, cast(least(supply, case when is_full then supply
  else floor(cast(remaining as double) / nullif(open_weight, 0) * weight) end) as bigint) as budget from o{depth})"""


ORACLE_SQL: dict[str, str] = {
    "op2_exact_dedup": """
select doc_id, keep_id, group_size, doc_id = keep_id as kept, text_sha256 from (
  select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    sha256(coalesce(text, '')) as text_sha256
  from documents window same as (partition by coalesce(text, '')))""",
    "op6_mixing": f"""
with d as (select doc_id, coalesce(source, '') as source, coalesce(lang, '') as lang,
    'd' || cast(cast(case when regexp_extract(coalesce(source, ''), '([0-9]{{1,4}})$', 1) = '' then '0'
      else regexp_extract(coalesce(source, ''), '([0-9]{{1,4}})$', 1) end as int) % 4 as varchar) as domain,
    cast(len({_WORDS}) as bigint) as tokens from documents),
leaves as (select domain, lang, source, cast(sum(tokens) as bigint) as tokens from d group by all),
total as (select cast(floor(sum(tokens) * {MIX["share"]}) as bigint) as b from leaves),
{",".join(_level(depth) for depth in (1, 2, 3))},
l as (select *, case when tokens > 0 then budget // tokens else 0 end as full_epochs from leaves join b3 using (domain, lang, source)),
k as (select d.*, full_epochs, budget - full_epochs * l.tokens as room,
  md5(concat('{MIX["seed"]}:', cast(full_epochs as varchar), ':', coalesce(cast(doc_id as varchar), ''))) as key
  from d join l using (domain, lang, source)),
c as (select *, sum(tokens) over (partition by domain, lang, source order by key) as so_far from k)
select doc_id, domain, lang, source, tokens as n_tokens,
  cast(full_epochs + case when so_far <= room and room > 0 then 1 else 0 end as int) as copies from c""",
    "op7_decontamination": f"""
with dw as (select doc_id, rowid_ as r, {_LOWER_WORDS} as ws from (select *, row_number() over () as rowid_ from documents)),
iw as (select item_id, rowid_ as r, {_LOWER_WORDS} as ws from (select *, row_number() over () as rowid_ from benchmark) where item_id is not null),
ds as (select distinct r, doc_id, array_to_string(ws[i:i + 4], ' ') as s from dw, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as t(i) where len(ws) > 0),
short as (select distinct len(ws) as m from iw where len(ws) between 1 and 4),
dr as (select distinct r, doc_id, array_to_string(ws[i:i + m - 1], ' ') as s from dw, short, unnest(range(1, len(ws) - m + 2)) as t(i)
  where len(ws) >= m),
ds_all as (select * from ds union select * from dr),
its as (select distinct r, item_id, array_to_string(ws[i:i + 4], ' ') as s from iw, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as t(i) where len(ws) > 0),
n as (select r, count(*) as size from its group by r),
m as (select d.r as dr, i.r as ir, any_value(doc_id) as doc_id, any_value(item_id) as item_id, count(*) as shared
  from ds_all d join its i using (s) group by all)
select doc_id, item_id, shared, size, shared / cast(size as double) as containment
from m join n on m.ir = n.r where shared >= 0.8 * size - 1e-9""",
    "op9_substring_dedup": f"""
with w as (select doc_id, row_number() over () as r, {_WORDS} as ws from documents),
g as (select doc_id, r, i, array_to_string(ws[i:i + 12], ' ') as k from w, unnest(range(1, len(ws) - 11)) as t(i) where doc_id is not null),
m as (select k, min(doc_id) as least from g group by k),
x as (select distinct r, i + j as p from g join m using (k), unnest(range(0, 13)) as t(j) where least < doc_id),
p as (select doc_id, r, i as p, ws[i] as word from w, unnest(range(1, len(ws) + 1)) as t(i)),
a as (select r, count(*) as n_words, count(x.p) as n_removed, string_agg(word, ' ' order by p.p) filter (where x.p is null) as kept
  from p left join x using (r, p) group by r)
select doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256 from w left join a using (r)""",
    "op11_suffix_dedup": """
with d as (select doc_id, row_number() over () as r, hex(encode(coalesce(text, ''))) as x from documents),
g as (select doc_id, r, unnest([{'i': i, 'k': md5_number(substr(x, 2 * i + 1, 200))} for i in range(0, len(x) // 2 - 99)]) as w from d),
v as (select r, i from (select r, w.i as i, row_number() over (partition by w.k order by doc_id, w.i) as place from g) where place > 1),
n as (select r, i, i > lag(i) over (partition by r order by i) + 100 as gap from v),
s as (select r, i, sum(case when gap is null or gap then 1 else 0 end) over (partition by r order by i) as span from n),
runs as (select r, span, min(i) as a, max(i) + 100 as b from s group by all),
cuts as (select r, span, a, b, coalesce(lag(b) over (partition by r order by a), 0) as before from runs),
k as (select r, count(*) as n_spans, sum(b - a) as n_removed, max(b) as last,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' order by a) as kept
  from cuts join d using (r) group by r)
select doc_id, cast(len(x) // 2 as bigint) as n_bytes, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) as kept_sha256
from d left join k using (r)""",
    "op13_lexical_search": rf"""
with d as (select row_number() over () as r, doc_id, {_TERMS} as ts from documents),
i as (select row_number() over () as q, item_id, {_TERMS} as ts from benchmark where item_id is not null),
want as (select q, item_id, term, count(*) as c from (select q, item_id, unnest(ts) as term from i) group by all),
totals as (select count(*) filter (len(ts) > 0) as n_docs, coalesce(sum(len(ts)), 0) as n_terms from d),
p as (select r, doc_id, n, term, count(*) as tf from (select r, doc_id, len(ts) as n, unnest(ts) as term from d)
  where term in (select term from want) group by all),
w as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / cast(2 * count(*) + 1 as double))) as bigint) as w
  from p, totals group by term, n_docs),
s as (select q, item_id, r, doc_id,
    cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms)))) as bigint) as score
  from want join p using (term) join w using (term), totals group by all),
best as (select *, row_number() over (partition by q order by score desc, doc_id nulls last) as place from s where score > 0)
select item_id, cast(place as int) as rank, doc_id, score from best where place <= 10""",
}
