"""The registered queries of the numbered operators, each over its whole table with
production parameters, and their DuckDB SQL where SQL can express them.  The queries only
derive the contract's columns from what the operators return."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starkpi.llm import (
    bpe, embedding_dedup, importance, lexical, licenses, mixing, order_minhash, packing, secret_scan, simhash, simple8b,
    toxicity, url_reputation)
from starkpi.llm.common import WORD
from starkpi.llm.license_texts import DIGESTS, HEADERS, NAMES, PHRASES, SPELLINGS, TEXTS, TITLES


def vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(_documents(spark, sf_dir), shingle=3, radius=3)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return embedding_dedup.near_duplicates(vectors, threshold=0.9)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.decide(_documents(spark, sf_dir), [3, 1, 2], budget=1.5, max_repeat=2.0, keep=["doc_id"])
    return out.select("doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), (F.col("__copies") * F.col("__size")).alias("taken"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(_documents(spark, sf_dir))
    return out.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.roundtrip(_documents(spark, sf_dir), vocabulary("byte_bpe_50k.tiktoken")), "doc_id")


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = order_minhash.compare_edited(_documents(spark, sf_dir))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                      order_minhash.as_string(F.col("fingerprint")).alias("fingerprint"),
                      order_minhash.as_string(F.col("edited_fingerprint")).alias("edited_fingerprint"),
                      "near_edited", "near_next")


def op7_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = simple8b.scratch(spark)
    simple8b.write(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), path, end_id=1)
    return simple8b.read_checksums(spark, path)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.in_fold(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir))


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
         ("allow", "com/fr/"), ("block", "com/de/")]


# Fixed value: a page's url names its document by a number below the language.
DOCUMENT_OF_PATH = r"^/[^/]+/([0-9]{1,18})([^0-9]|$)"


def op10_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outcome of a page is the label of the document that its url names: bad where that
    is toxic or of low quality."""
    pages, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "labels"))
    number = F.regexp_extract(url_reputation.path_of(F.col("url")), DOCUMENT_OF_PATH, 1)
    named = pages.select("page_id", F.nullif(number, F.lit("")).cast("long").alias("doc_id"))
    bad = labels.groupBy("doc_id").agg(F.max(F.greatest(
        F.coalesce("toxic", F.lit(0)), 1 - F.coalesce("quality", F.lit(1)))).alias("bad"))
    outcomes = named.join(bad, "doc_id").select("page_id", (F.col("bad") == 1).alias("bad"))
    return url_reputation.judge(pages, outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = importance.resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
                              percent=10, least_words=20, longest=1, n_buckets=10_000, seed=2024, keep=["doc_id"])
    return out.select("doc.doc_id", "n_features", "weight", "score", "rank")


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack(_documents(spark, sf_dir), vocabulary("word_bpe_49k.json"), capacity=4096, end_id=2)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = lexical.build(_documents(spark, sf_dir))
    return lexical.search(spark, path, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), top=20)


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_secrets": op4_secrets,
    "op5_bpe": op5_bpe,
    "op6_order_minhash": op6_order_minhash,
    "op7_simple8b": op7_simple8b,
    "op8_toxicity": op8_toxicity,
    "op9_licenses": op9_licenses,
    "op10_url_reputation": op10_url_reputation,
    "op11_importance": op11_importance,
    "op12_packing": op12_packing,
    "op13_lexical": op13_lexical,
}

_MIXING = f"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::bigint as size,
         ('0x' || substr(md5('42:' || coalesce(doc_id::varchar, text, '')), 1, 13))::bigint / 4503599627370496.0::double as draw
  from documents),
s as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) - 1 as place
  from d group by source),
w as (
  select *, [3.0::double, 1.0, 2.0][place % 3 + 1] as weight, 2.0::double * source_size as cap,
         1.5::double * sum(source_size) over () as total from s),
f as (
  select *, cap / weight as full_at,
         (total - coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as level from w),
water as (select arg_min(level, place_by_full) as water from (
  select level, full_at, row_number() over (order by full_at, place) as place_by_full from f) where full_at >= level),
p as (
  select source, source_size, case when water is null then cap else least(cap, water * weight) end as target
  from f cross join water),
r as (select *, case when source_size > 0 then least(target / source_size, 2.0::double) else 0 end as rate from p)
select doc_id, size, source_size, target,
       (floor(rate)::bigint + case when draw < rate - floor(rate) then 1 else 0 end) * size as taken
from d join r on d.source is not distinct from r.source
"""


def _secrets_sql(reach: int = 200) -> str:
    kinds, base = secret_scan.KINDS, len(secret_scan.BASE)
    found = " union all ".join(
        f"""select k, {i} as rank, unnest(string_split_regex(text, $${p}$$)) as gap,
            unnest(regexp_extract_all(text, $${p}$$)) as hit,
            {f"unnest(regexp_extract_all(text, $${p}$$, 2))" if kind == "assign" else "''"} as value,
            unnest(range(1, 1 + len(regexp_extract_all(text, $${p}$$)))) as number
            from t where regexp_matches(text, $${p}$$)"""
        for i, (kind, p) in enumerate(secret_scan.PATTERNS.items()))
    secrets = ", ".join(str(kinds.index(k)) for k in secret_scan.SECRETS)
    listed = "string_agg({}[rank + 1] || ':' || start || ':' || stop, ',' order by start, rank, stop)".format(
        "[" + ", ".join(f"'{k}'" for k in kinds) + "]")
    return f"""
with t as (select doc_id, row_number() over () as k, coalesce(text, '') as text from documents),
found as ({found}),
placed as (select k, rank, number, hit, value, sum(length(gap) + length(hit)) over (partition by k, rank order by number)::bigint as stop
           from found where number is not null),
parts as (select k, rank, stop - length(hit) as start, stop from placed
          where (rank <> 0 or length(value) >= 6)
            and (rank <> 4 or (regexp_matches(hit, '[a-z]') and regexp_matches(hit, '[A-Z]') and regexp_matches(hit, '[0-9]')))),
linked as (select s.k, s.rank as r1, s.start as a1, s.stop as b1, c.rank as r2, c.start as a2, c.stop as b2
           from parts s join parts c on s.k = c.k and s.rank in ({secrets}) and c.rank not in ({secrets})
            and greatest(c.start - s.stop, s.start - c.stop) between 0 and {reach}),
weak as (select k, r1 as rank, a1 as start, b1 as stop from linked union select k, r2, a2, b2 from linked),
spans as (select * from parts where rank < {base} union all
          select * from weak w where rank >= {base} and not exists (
            select 1 from parts p where p.rank < {base} and p.k = w.k and p.start <= w.start and p.stop >= w.stop)),
per as (select k, count(*) filter (rank = 0) as a, count(*) filter (rank = 1) as b, count(*) filter (rank = 2) as c,
               {listed.replace("string_agg(", "coalesce(string_agg(").replace(" order by start, rank, stop)", " order by start, rank, stop) filter (rank < " + str(base) + "), '')")} as base,
               {listed} as spans from spans group by k)
select doc_id, coalesce(a, 0)::bigint as n_assign, coalesce(b, 0)::bigint as n_access, coalesce(c, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from t left join per using (k)
"""


def _licenses_sql() -> str:
    def line(x: str) -> str:
        words = f"' ' || regexp_replace(lower({x}), $${licenses.NOT_WORD}$$, '  ', 'g') || ' '"
        for other, usual in SPELLINGS.items():
            words = f"replace({words}, ' {other.replace(' ', '  ')} ', ' {usual.replace(' ', '  ')} ')"
        notice = (f"regexp_matches({x}, $r${licenses.NOTICE_LINE}$r$) or (regexp_matches({x}, $r${licenses.NAMED_LINE}$r$) "
                  f"and not regexp_matches({x}, $r${licenses.OWN_WORDS}$r$))")
        return f"case when {notice} then '' else trim(replace({words}, '  ', ' ')) end"

    def split(text: str) -> str:
        return f"string_split_regex(coalesce({text}, ''), $$\r?\n|\r$$)"

    def lines(text: str) -> str:
        return f"list_filter(list_transform({split(text)}, lambda x: {line('x')}), lambda x: x <> '')"

    def whole(rows: str) -> str:
        out = f"' ' || array_to_string({rows}, ' ') || ' '"
        for other, usual in SPELLINGS.items():
            if " " in other:
                out = f"replace({out}, ' {other} ', ' {usual} ')"
        return f"trim({out})"

    both = f"$r${licenses.COPYRIGHT_AND_NOTICE}$r$"
    texts = ", ".join(f"('{name}', $${title}\n{text}$$)" for name, text in TEXTS.items() for title in ("", *TITLES[name]))
    stored = ", ".join(f"('{name}', '{d}')" for name, digests in DIGESTS.items() for d in digests)
    headers = ", ".join(f"('{name}', $${h}$$)" for name, rows in HEADERS.items() for h in rows)
    names = ", ".join(f"('{name}', '{alias}')" for name, aliases in NAMES.items() for alias in aliases)
    phrases = ", ".join(f"('{p}')" for p in PHRASES)
    return f"""
with known as (
  select 'text' as kind, name, text from (values {texts}) v(name, text) union all
  select 'notice', name, text from (values {headers}) v(name, text) union all
  select 'notice', name, phrase || ' ' || art || alias
  from (values {names}) n(name, alias), (values {phrases}) p(phrase), (values (''), ('the ')) a(art)),
digests as (select kind, digest, min(name) as license from (
  select kind, name, sha256({whole(lines("text"))}) as digest from known union all
  select 'text', name, digest from (values {stored}) v(name, digest)) group by all),
d as (select doc_id, row_number() over () as k, {lines("text")} as lines,
             list_transform(list_filter({split("text")}, lambda x: regexp_matches(x, {both})),
                            lambda y: {line(f"regexp_extract(y, {both}, 2)")}) as after from documents),
notices as (
  select k, count(*) as n, string_agg(distinct license, ',' order by license) as names
  from (select k, unnest(list_concat(lines, after)) as line from d) join digests on kind = 'notice' and digest = sha256(line) group by k),
w as (select doc_id, k, sha256({whole("lines")}) as digest from d)
select doc_id, w.digest, t.license, coalesce(n, 0)::bigint as n_notices, coalesce(names, '') as notices
from w left join digests t on t.kind = 'text' and t.digest = w.digest left join notices using (k)
"""


def _reputation_sql(max_bad: float = 0.35, z: float = 1.645) -> str:
    two_label = ", ".join(f"'{x}'" for x in url_reputation.TWO_LABEL_SUFFIXES)
    rules = ", ".join(f"('{v}', '{r}', '{r.partition('/')[0]}', '/{r.partition('/')[2]}')" for v, r in RULES)

    def level(name: str, key: str, source: str) -> str:
        return f"""
{name}_r as (select (sum(n * (bad / n - m) ^ 2 / (m * (1 - m))) - count(*)) / nullif(sum(n) - count(*), 0) as r
  from {source} where n > 0 and m > 0 and m < 1),
{name}_s as (select case when r > 0 then greatest(1.0, least(1e6, 1 / r - 1)) else 1e6 end as s from {name}_r),
{name} as (select {key}, n, bad, bad + least(s, w) * m as a, n - bad + least(s, w) * (1 - m) as b from {source}, {name}_s)"""

    return f"""
with p as (
  select page_id, translate(regexp_extract(coalesce(url, ''), $${url_reputation.URL}$$, 1),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), $${url_reputation.URL}$$, 2) as path from pages),
lab as (
  select page_id as labelled, max((coalesce(toxic, 0) = 1 or coalesce(quality, 1) = 0)::int) as bad
  from p join labels on doc_id = try_cast(regexp_extract(path, $${DOCUMENT_OF_PATH}$$, 1) as bigint)
  where page_id is not null group by page_id),
hosts0 as (select host, count(lab.bad)::double as n, coalesce(sum(lab.bad), 0)::double as bad
           from p left join lab on page_id = labelled group by host),
cut as (select *, string_split(host, '.') as l, array_to_string(string_split(host, '.')[-2:], '.') as two from hosts0),
hosts as (select host, n, bad,
                 case when two in ({two_label}) then array_to_string(l[-3:], '.') else two end as domain,
                 case when two in ({two_label}) then two else l[-1] end as suffix from cut),
suffix0 as (select suffix, sum(n) as n, sum(bad) as bad, (select (sum(bad) + 0.5) / (sum(n) + 1.0) from hosts) as m,
                   (select sum(n) + 1.0 from hosts) as w from hosts group by suffix),
{level("suffixes", "suffix", "suffix0")},
domain0 as (select domain, d.n, d.bad, a / (a + b) as m, a + b as w from (
  select domain, sum(n) as n, sum(bad) as bad, any_value(suffix) as suffix from hosts group by domain) d join suffixes using (suffix)),
{level("domains", "domain", "domain0")},
host0 as (select host, h.n, h.bad, a / (a + b) as m, a + b as w from hosts h join domains using (domain)),
{level("judged", "host", "host0")},
reputation as (select host, greatest(0.0, a / (a + b) - {z} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))) as low from judged),
rules(verdict, rule, rule_host, rule_path) as (values {rules}),
fits as (select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
         from p join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by page_id)
select page_id, host, path, rule, coalesce(verdict, case when low > {max_bad} then 'block' else 'allow' end) as verdict
from p left join fits using (page_id) join reputation using (host)
"""


def _lexical_sql(top: int = 20) -> str:
    terms = ("unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"$$[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+$$)) as term")
    return f"""
with docs as (select row_number() over () as k, doc_id, text from documents),
words as (select k, {terms} from docs),
tf as (select k, term, count(*) as tf from words group by k, term),
size as (select k, sum(tf)::bigint as n from tf group by k),
total as (select count(*) as n_docs, sum(n)::bigint as n_terms from size),
weight as (select term, floor(1000 * ln((2.0::double * n_docs + 2) / (2.0::double * count(*) + 1)))::bigint as w
           from tf, total group by term, n_docs),
items as (select row_number() over () as item, item_id, text from benchmark),
asked as (select item, term, count(*) as q from (select item, {terms} from items) group by item, term),
scores as (
  select item, tf.k, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms))))::bigint as score
  from asked join tf using (term) join weight using (term) join size on size.k = tf.k, total group by item, tf.k),
ranked as (select item, doc_id, score, row_number() over (partition by item order by score desc, doc_id nulls last) as rank
           from scores join docs on docs.k = scores.k where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked join items using (item) where rank <= {top}
"""


ORACLE: dict[str, str] = {
    "op2_mixing": _MIXING,
    "op4_secrets": _secrets_sql(),
    "op9_licenses": _licenses_sql(),
    "op10_url_reputation": _reputation_sql(),
    "op13_lexical": _lexical_sql(),
}
