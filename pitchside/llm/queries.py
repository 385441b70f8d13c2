"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (divergence, html, jaccard, licenses, lines, mixing, packing, phrases, quality, substring, suffix,
               syncmers, urls)
from .keys import doc_id_of

# Target weights of the mixing query (fixed values); the rest weighs 1.
DOMAIN_WEIGHTS = {"src1": 2, "src0": 3}
SOURCE_WEIGHTS = {"src7": 2, "src10": 5, "src12": 2, "src19": 3}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


@query
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.digests(suffix.remove_repeated(table(spark, sf_dir, "documents")))


@query
def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mix(table(spark, sf_dir, "documents"), domain=mixing.family_of(F.col("source")),
                       domain_weights=DOMAIN_WEIGHTS, source_weights=SOURCE_WEIGHTS)
    return drawn.select(doc_id_of(drawn["doc_key"]).alias("doc_id"), "domain", "lang", "source", "epoch",
                        "tokens", "taken")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return substring.digests(substring.remove_repeated(docs, window=20, base=10))


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(table(spark, sf_dir, "documents"))


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_documents(table(spark, sf_dir, "documents"))


@query
def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query
def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query
def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digests(lines.drop_common(table(spark, sf_dir, "documents")))


# The budget tree in SQL: the same water-filling over window sums, with
# huge integers; word tokens; seeded order by MD5.
_SHARE = """
{name}_o as (select *, coalesce(sum(capacity) over (partition by {parent} order by capacity::double / weight, {key}
    rows between unbounded preceding and 1 preceding), 0) fb,
  sum(weight) over (partition by {parent} order by capacity::double / weight, {key}
    rows between current row and unbounded following) wf from {name}_i),
{name}_f as (select *, capacity::hugeint * wf::hugeint <= (budget - fb)::hugeint * weight::hugeint is_full from {name}_o),
{name}_s as (select *, sum(case when is_full then capacity else 0 end) over (partition by {parent}) taken_all,
  sum(case when is_full then 0 else weight end) over (partition by {parent}) w_all from {name}_f),
{name} as (select *, case when is_full then capacity
  else ((budget - taken_all)::hugeint * weight::hugeint) // w_all::hugeint end granted from {name}_s)"""

def _weight(column: str, weights: dict[str, int]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then {w}" for k, w in weights.items()) + " else 1 end"


ORACLES["op3_mixing"] = f"""
with rows_ as (
  select distinct doc_id, coalesce(text, '') text, regexp_extract(coalesce(source, ''), '^[A-Za-z]*[0-9]?') domain_,
    coalesce(lang, '') lang_, coalesce(source, '') source_ from documents),
t as (select *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::bigint tokens from rows_),
leaf as (select domain_, lang_, source_, sum(tokens)::bigint tokens, sum(tokens)::bigint * {mixing.MAX_EPOCHS} capacity
  from t group by all having sum(tokens) > 0),
d_i as (select domain_, sum(capacity)::bigint capacity, {_weight('domain_', DOMAIN_WEIGHTS)} weight, 0 root,
  (select sum(tokens)::bigint from leaf) budget from leaf group by 1),
{_SHARE.format(name="d", parent="root", key="domain_")},
l_i as (select l.domain_, l.lang_, sum(l.capacity)::bigint capacity,
  case l.lang_ when 'en' then 4 when 'de' then 2 when 'fr' then 2 when 'es' then 2 else 1 end weight,
  any_value(d.granted) budget from leaf l join d using (domain_) group by 1, 2),
{_SHARE.format(name="l", parent="domain_", key="lang_")},
s_i as (select leaf.*, {_weight('source_', SOURCE_WEIGHTS)} weight, l.granted budget from leaf join l using (domain_, lang_)),
{_SHARE.format(name="s", parent="domain_, lang_", key="source_")},
plan as (select domain_, lang_, source_, (granted // tokens)::bigint whole, (granted % tokens)::bigint rest from s),
placed as (select t.*, whole, rest, coalesce(sum(tokens) over (partition by domain_, lang_, source_
    order by md5('{mixing.SEED}:' || whole || ':' || coalesce(doc_id::varchar, 'null')), coalesce(doc_id, {(1 << 63) - 1})
    rows between unbounded preceding and 1 preceding), 0) start_
  from t join plan using (domain_, lang_, source_) where tokens > 0),
epochs as (select *, unnest(range(0, whole + 1)) e from placed)
select doc_id, domain_ as domain, lang_ as lang, source_ as source, e::int as epoch, tokens,
  (case when e < whole then tokens else greatest(0, least(tokens, rest - start_)) end)::bigint as taken
from epochs where e < whole or greatest(0, least(tokens, rest - start_)) > 0"""

# Base counts in SQL would need every 5-word window of every text as a row,
# too slow on whole tables; the tests compare them with plain Python.


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

ORACLES["op11_divergence_audit"] = rf"""
with d as (select row_number() over () r, coalesce(lang, '') lang, coalesce(source, '') source, coalesce(text, '') x from documents),
w as (select r, lang, source, translate(unnest(regexp_extract_all(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')), {_LOWER}) term from d),
kept as (select lang, term, count(*) k from w group by all having count(distinct r) >= {divergence.LEAST_DOCUMENTS}),
l as (select lang, sum(k) n, count(*) v from kept group by 1),
q as (select lang, term, 1 + (({divergence.UNIT}::hugeint * (k + {divergence.ADD})) // (n + {divergence.ADD} * v)) q from kept join l using (lang)),
g as (select distinct lang, source from d),
c as (select lang, source, term, count(*) k from w join kept using (lang, term) group by all),
gn as (select lang, source, coalesce(sum(c.k), 0) n from g left join c using (lang, source) group by all),
p as (select gn.lang, gn.source, kept.term, coalesce(c.k, 0) k,
  1 + (({divergence.UNIT}::hugeint * (coalesce(c.k, 0) + {divergence.ADD})) // (gn.n + {divergence.ADD} * l.v)) p
  from gn join kept using (lang) join l using (lang)
  left join c on c.lang = gn.lang and c.source = gn.source and c.term = kept.term),
pairs as (select a.lang, a.source, b.source item, coalesce(sum(abs(x.p - y.p)), 0)::bigint as value
  from g a join g b on a.lang = b.lang and a.source <> b.source
  left join p x on x.lang = a.lang and x.source = a.source
  left join p y on y.lang = b.lang and y.source = b.source and y.term = x.term group by all),
terms as (select lang, source, term item, (p - q)::bigint as value from p join q using (lang, term) where k > 0 and p > q),
ranked as (select *, 'pair' part, row_number() over (partition by lang, source order by value desc, item) rank from pairs
  union all by name
  select *, 'term' part, row_number() over (partition by lang, source order by value desc, item) rank from terms)
select lang, source, part, item, value, rank::int as rank from ranked where part = 'pair' or rank <= {divergence.TOP_TERMS}"""

ORACLES["op12_phrase_mining"] = rf"""
with p as (select coalesce(lang, '{phrases.NO_LANG}') lang,
  regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), {_LOWER}), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') w from documents),
grams as (select lang, k, array_to_string(w[i:i + k - 1], ' ') phrase from (
  select *, unnest(range(1, len(w) - k + 2)) i from p, range(1, {phrases.LONGEST + 1}) t(k))),
f as (select lang, k::int k, phrase, count(*) a from grams group by all having count(*) >= {phrases.LEAST_COUNT}),
n as (select lang, sum(len(w)) n from p group by 1),
s as (select *, string_split(phrase, ' ') ws from f where k > 1),
cuts as (select lang, phrase, k, a, unnest(range(1, k)) c, ws from s),
priced as (select x.lang, x.phrase, x.k, x.a, c, u.a l, v.a r, ({phrases.UNIT}::hugeint * x.a) // (u.a + v.a) score from cuts x
  join f u on u.lang = x.lang and u.phrase = array_to_string(ws[1:c], ' ')
  join f v on v.lang = x.lang and v.phrase = array_to_string(ws[c + 1:], ' ')),
best as (select * from priced qualify row_number() over (partition by lang, phrase order by score, c) = 1),
inner_ as (select lang, array_to_string(ws[i:i + m - 1], ' ') phrase, a from (
  select *, unnest(range(1, k - m + 2)) i from s, range(2, {phrases.LONGEST}) t(m) where m < k)),
longer as (select lang, phrase, max(a) a from inner_ group by all),
live as (select b.* from best b left join longer o using (lang, phrase) where o.a is null or 100 * o.a < {phrases.COVERED} * b.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) rank from live)
select lang, rank::int as rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked join n using (lang) where rank <= {phrases.TOP}"""

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
ORACLES["op13_line_dedup"] = f"""
with d as (select row_number() over () r, doc_id, coalesce(doc_id, {(1 << 63) - 1}) k, string_split(coalesce(text, ''), chr(10)) x from documents),
c as (select r, k, unnest(x) line, generate_subscripts(x, 1) i from d),
t as (select *, translate(trim(line, {_BLANKS}), {_LOWER}) line_key from c),
f as (select line_key, max(k) last from t where length(line_key) >= {lines.LEAST_CHARS}
  group by 1 having count(distinct k) >= {lines.LEAST_DOCUMENTS}),
m as (select t.*, coalesce(last <> k, false) gone from t left join f using (line_key)),
s as (select r, count(*) n_lines, count(*) filter (gone) n_dropped, string_agg(line, chr(10) order by i) filter (not gone) kept from m group by 1)
select doc_id, n_lines, n_dropped, sha256(coalesce(kept, '')) as kept_sha256 from s join d using (r)"""
