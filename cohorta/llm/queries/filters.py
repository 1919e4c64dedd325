"""Queries that judge, scan or score single documents and pages."""

from __future__ import annotations

from cohorta.llm import host_rules, quality, secrets, url_filter
from cohorta.llm.common import table
from cohorta.llm.queries.registry import query

# The rules of the URL contract.
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def _terms_sql(terms: list[str]) -> str:
    return " + ".join(f"regexp_matches(low, '(^|[^a-z0-9]){t}($|[^a-z0-9])')::int" for t in terms)


@query("op2_url_vocabulary", sql=f"""
with parts as (
  select page_id, translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as low,
         coalesce(case when contains(url, '://') then substr(url, strpos(url, '://') + 3) end, '') as rest
  from pages),
split as (
  select page_id, low,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') as path
  from parts),
judged as (
  select page_id, host, path,
         case when ('.' || host) like '%.example.net' and path like '/en/%' then 'example.net/en/'
              when ('.' || host) like '%.example.com' and path like '/de/%' then 'example.com/de/'
              when ('.' || host) like '%.org' and path like '/fr/%' then 'org/fr/'
              when ('.' || host) like '%.net' and path like '/%' then 'net/' end as rule,
         coalesce({_terms_sql(url_filter.STRICT)}, 0)::int as n_strict,
         coalesce({_terms_sql(url_filter.SOFT)}, 0)::int as n_soft
  from split)
select page_id, host, path, rule, n_strict, n_soft,
       case when rule in ('example.net/en/', 'org/fr/') then 'allow' when rule is not null then 'block'
            when n_strict > 0 or n_soft >= 2 then 'block' else 'allow' end as verdict
from judged""")
def url_vocabulary(spark, folder):
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES)


@query("op5_pairwise_quality")
def pairwise_quality(spark, folder):
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op7_host_rules", sql="""
with words as (
  select doc_id, source, text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
flat as (
  select doc_id, unnest(w) as word, generate_subscripts(w, 1) as i from words),
grams as (
  select doc_id, i, word || ' ' || lead(word, 1) over o || ' ' || lead(word, 2) over o as gram
  from flat window o as (partition by doc_id order by i)),
twice as (
  select doc_id, i, count(*) over (partition by doc_id, gram) as n from grams where gram is not null),
marked as (
  select doc_id, count(distinct i + k)::bigint as n_repeat_words
  from twice, (values (0), (1), (2)) as v(k) where n > 1 group by doc_id),
lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line from documents),
dups as (
  select doc_id, (count(*) - count(distinct line))::bigint as n_dup_lines
  from lines where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by doc_id),
counts as (
  select doc_id, source, len(w)::bigint as n_words,
         coalesce(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')), 0)::bigint as word_chars,
         coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0)::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from words left join dups using (doc_id) left join marked using (doc_id)),
judged as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from counts),
hosts as (
  select source, count(*)::double as n, sum(base_failed::int)::double as failed
  from judged where source is not null group by source),
sums as (
  select sum(failed) / sum(n) as mean,
         greatest(sum(failed * failed / n) / sum(n) - power(sum(failed) / sum(n), 2)
                  - sum(failed / n * (1 - failed / n)) / sum(n), 0) as variance
  from hosts),
prior as (
  select mean, case when variance > 1e-12 * mean * (1 - mean) and mean * (1 - mean) > 0
                    then least(greatest(mean * (1 - mean) / variance - 1, 1e-3), 1e6) else 1e6 end as strength
  from sums),
verdicts as (
  select source, (failed + greatest(mean * strength, 1e-9))
                 / (n + greatest(mean * strength, 1e-9) + greatest((1 - mean) * strength, 1e-9)) > 0.5 as host_failed
  from hosts, prior)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not coalesce(host_failed, false) as kept
from judged left join verdicts using (source)""")
def rules_by_host(spark, folder):
    judged = host_rules.host_rules(table(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept")


@query("op8_secret_structure")
def secret_structure(spark, folder):
    return secrets.scan(table(spark, folder, "documents"), with_text=False).drop("redacted")
