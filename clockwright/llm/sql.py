"""DuckDB statements for the queries over text; they share no code with the operators."""

from __future__ import annotations

EXACT_DEDUP = """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id = max(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)
"""

#: turns are taken one by one: shard (turn mod 32) claims the first free slot of its permutation
SHARDING = """
with recursive shard as (
    select i, format('shard-{:02d}', i) as name,
           ('0x' || substr(md5(format('shard-{:02d}', i) || ':first'), 1, 15))::bigint % 4099 as f,
           ('0x' || substr(md5(format('shard-{:02d}', i) || ':step'), 1, 15))::bigint % 4098 + 1 as s
    from range(32) r(i)),
preference as materialized (
    select i, list((f + j * s) % 4099 order by j) as slots from shard, range(4099) p(j) group by i),
preferences as materialized (select list(slots order by i) as of from preference),
turn as (
    select 0 as t, null::bigint as slot, list_transform(range(4099), lambda x: false) as claimed
    union all
    select t + 1, pick, list_transform(claimed, lambda taken, place: taken or place - 1 = pick)
    from (select t, claimed, list_filter(of[t % 32 + 1], lambda x: not claimed[x + 1])[1] as pick
          from turn, preferences where t < 4099)),
owner as (select slot, name as shard from turn join shard on i = (t - 1) % 32 where t > 0)
select doc_id, o.slot::int as slot, o.shard
from documents join owner o
  on o.slot = ('0x' || substr(md5(coalesce(doc_id::varchar, text, '')), 1, 15))::bigint % 4099
"""

#: label, wording, key phrase and its position, second key phrase and its position
_NOTICES = [
    ("mit", "released under the mit license", "mit license", 3, None, 0),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files", "permission is hereby granted", 0, "free of charge", 4),
    ("apache-2", "licensed under the apache license version 2 0", "apache license version 2", 3, None, 0),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc", 2, None, 0),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa", 2, None, 0),
    ("gpl-3", "licensed under the gnu general public license version 3", "gnu general public license", 3, "version 3", 7),
    ("gpl-2", "licensed under the gnu general public license version 2", "gnu general public license", 3, "version 2", 7),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license", 3, None, 0),
    ("agpl-3", "licensed under the gnu affero general public license version 3",
     "gnu affero general public license", 3, None, 0),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0", "mozilla public license", 5, None, 0),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms", 0, None, 0),
    ("all-rights-reserved", "all rights reserved", "all rights reserved", 0, None, 0),
]


def _text(value: str | None) -> str:
    return "null" if value is None else f"'{value}'"


LICENSE_SCAN = f"""
with d as (
    select doc_id, list_filter(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as words
    from documents),
notice as (
    select row_number() over () as id, label, string_split(wording, ' ') as wording,
           string_split(key_one, ' ') as key_one, at_one, string_split(key_two, ' ') as key_two, at_two
    from (values {', '.join(f"({_text(a)}, {_text(b)}, {_text(c)}, {e}, {_text(f)}::varchar, {g})" for a, b, c, e, f, g in _NOTICES)})
         v(label, wording, key_one, at_one, key_two, at_two)),
phrase(label, part) as (values ('mit', ['under', 'the', 'mit', 'license']),
    ('apache-2', ['apache', 'license', 'version', '2']), ('cc-by-nc', ['cc', 'by', 'nc'])),
idf as (
    select w, ln((1 + (select count(*) from d)) / (1 + count(doc_id))) as weight
    from (select distinct unnest(wording) as w from notice)
    left join (select distinct doc_id, unnest(words) as has from d) on w = has group by w),
-- starts of a notice, from 0: where its first key phrase stands at its position
start as (
    select doc_id, id, unnest(list_filter(range(-at_one, len(words)),
               lambda s: words[s + at_one + 1:s + at_one + len(key_one)] = key_one
                     and s + at_one >= 0
                     and (key_two is null or words[s + at_two + 1:s + at_two + len(key_two)] = key_two))) as s
    from d, notice where list_has_all(words, key_one)),
share as (
    select doc_id, id, s, sum(case when s + i >= 0 and words[s + i + 1] = wording[i + 1] then weight else 0 end) / sum(weight) as score
    from start join d using (doc_id) join notice using (id), range(20) r(i) join idf on w = wording[i + 1]
    where i < len(wording) group by all),
found as (select doc_id, label, max(round(score, 6)) as score from share join notice using (id) group by all),
place as (
    select doc_id, label, unnest(list_filter(range(len(words)), lambda s: words[s + 1:s + len(part)] = part)) as s
    from d, phrase where list_has_all(words, part)),
base as (select doc_id, count(*) as n_base, min(s) as first_word, max(s) as last_word,
                string_agg(distinct label, ',' order by label) as base_labels from place group by all),
label as (
    select doc_id, string_agg(distinct label, ',' order by label) as labels
    from (select doc_id, label from place union all select doc_id, label from found where score >= 0.5) group by all),
top as (select doc_id, max(score) as score from found group by all)
select d.doc_id, len(words) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word,
       coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0) as score
from d left join base using (doc_id) left join label using (doc_id) left join top using (doc_id)
"""


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(lower({text}), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"


def _hashes(words: str) -> str:
    """Sorted list of the distinct shingle hashes of a column of word lists."""
    return (f"list_sort(list_distinct(list_transform(range(greatest(len({words}) - 4, least(len({words}), 1))), "
            f"lambda i: substr(md5(array_to_string({words}[i + 1:i + 5], ' ')), 1, 12))))")


#: of the hashes, those below a threshold, and the 64 smallest
_SKETCH = "list_filter({}, lambda h, i: h < '200000000000' or i <= 64)"
#: up to where a sketch has all hashes of its text; a sketch of fewer than 64 is the whole set
_REACH = "case when len({0}) < 64 then 'g' else greatest(list_max({0}), '1fffffffffff') end"


def _alike(other: str) -> str:
    """Share of the smaller sketch that both have, as far as both reach."""
    own, its = (f"list_filter({x}, lambda h: h <= to_{other})" for x in ("a", other))
    smaller = f"least(len({own}), len({its}))"
    return (f"case when {smaller} > 0 then len(list_intersect({own}, {its})) / {smaller} "
            f"else (len({own}) = len({its}))::int end::double")


FINGERPRINTS = f"""
with d as (
    select doc_id, coalesce(text, '') as text, coalesce(lead(text) over w, first_value(text) over w, '') as next_text
    from documents window w as (order by doc_id rows between unbounded preceding and unbounded following)),
e as (select *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) as edited from d),
w as materialized (
    select doc_id, length(text) as n_chars, sha256(edited) as edited_sha256, {_words('text')} as wa,
           {_words('edited')} as wb, {_words('next_text')} as wc from e),
h as materialized (
    select doc_id, n_chars, edited_sha256, {_hashes('wa')} as ha, {_hashes('wb')} as hb, {_hashes('wc')} as hc from w),
s as materialized (
    select doc_id, n_chars, edited_sha256, {_SKETCH.format('ha')} as a, {_SKETCH.format('hb')} as b,
           {_SKETCH.format('hc')} as c from h),
p as materialized (
    select *, least({_REACH.format('a')}, {_REACH.format('b')}) as to_b, least({_REACH.format('a')}, {_REACH.format('c')}) as to_c
    from s)
select doc_id, n_chars, edited_sha256, array_to_string(a, ' ') as fingerprint,
       array_to_string(b, ' ') as edited_fingerprint, {_alike('b')} as near_edited, {_alike('c')} as near_next
from p
"""


#: a run of three lines, or of one or two with 50 words, is removed where an equal run began earlier and has ended
LINE_DEDUP = r"""
with d as (
    select doc_id, sha256(coalesce(text, '')) as digest, text, string_split(coalesce(text, ''), chr(10)) as lines
    from documents),
counted as (
    select *, list_transform(lines, lambda x: len(list_filter(string_split_regex(x, '[\x20\x09-\x0D]+'), lambda w: w <> ''))) as words
    from d),
run as (
    select doc_id, digest, i, n, lines[i + 1:i + n] as run
    from (select *, unnest(range(len(lines))) as i from counted), range(1, 4) r(n)
    where i + n <= len(lines) and (n = 3 or list_sum(words[i + 1:i + n]) >= 50)),
first as (select run, min(row(doc_id, digest, i)) as f, count(*) as places from run group by run having count(*) > 1),
removed as (
    select doc_id, digest, list(distinct i + k) as gone
    from (select *, unnest(range(n)) as k from run join first using (run))
    where not (f[1] = doc_id and f[2] = digest) or i >= f[3] + n
    group by doc_id, digest)
select doc_id, len(lines) as n_lines, coalesce(len(gone), 0) as n_removed,
       case when gone is null then text
            else array_to_string(list_filter(lines, lambda x, i: not list_contains(gone, i - 1)), chr(10)) end as text
from d left join removed using (doc_id, digest)
"""


def _mixing(sweeps: int = 8) -> str:
    steps, last, n = [], "w0", 0
    for _ in range(sweeps):
        for dimension in ("source", "lang", "topic"):
            n += 1
            steps.append(
                f"w{n} as materialized (select c.source, c.lang, c.topic, c.tokens, "
                f"c.weight * (case when s.share > 0 then coalesce(t.target, 0) / s.share else 0 end) as weight "
                f"from {last} c join (select {dimension} as k, sum(weight) as share from {last} group by 1) s "
                f"on c.{dimension} = s.k left join t_{dimension} t on t.k = s.k)")
            last = f"w{n}"
    def tempered(dimension: str) -> str:
        return (f"t_{dimension} as materialized (select {dimension} as k, pow(sum(tokens), 0.7) "
                f"/ sum(pow(sum(tokens), 0.7)) over () as target from cell group by 1 having sum(tokens) > 0)")
    return f"""
with d as materialized (
    select doc_id, coalesce(source, '(none)') as source, coalesce(lang, '(none)') as lang,
           case when contains(text, 'icense') or contains(text, 'rights reserved') then 'licence'
                when contains(text, '@') then 'contact' when contains(text, ' | ') then 'table'
                when contains(text, '!!') then 'loud' else 'general' end as topic,
           len(list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) as tokens
    from documents),
cell as materialized (select source, lang, topic, sum(tokens) as tokens from d group by all),
{tempered('source')}, {tempered('topic')},
t_lang as materialized (
    select k, w / sum(w) over () as target
    from (values ('en', 0.55::double), ('de', 0.15::double), ('fr', 0.15::double), ('es', 0.15::double)) v(k, w)
    where k in (select lang from cell where tokens > 0)),
w0 as materialized (select *, tokens / (select sum(tokens) from cell) as weight from cell),
{', '.join(steps)},
factor as (select source, lang, topic, case when tokens > 0 then weight / tokens else 0 end as factor from {last}),
p as (select source, lang, topic, round(factor / (select max(factor) from factor), 9) as probability from factor)
select doc_id, source, lang, topic, tokens, probability,
       ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':mix:0'), 1, 12))::bigint / pow(16, 12) < probability as sampled
from d join p using (source, lang, topic)
"""


MIXING = _mixing()


SEARCH = r"""
with item_term as materialized (
    select distinct item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark),
word as materialized (
    select doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents),
size as materialized (select doc_id, count(*) as n from word group by 1),
total as (select count(*) as docs, sum(n)::bigint as words from size),
posting as materialized (
    select doc_id, term, count(*) as tf from word where term in (select term from item_term) group by all),
weight as (
    select term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::bigint as w
    from posting, total group by term, docs),
value as materialized (
    select doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))) as v
    from posting join weight using (term) join size using (doc_id), total),
score as (
    select item_id, doc_id, sum(v)::bigint as score from value join item_term using (term) group by all),
ranked as (
    select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id) as place
    from score where score > 0)
select item_id, place::int as rank, doc_id, score from ranked where place <= 50
"""

PASSAGES = r"""
with d as materialized (
    select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
    from documents),
win as materialized (
    select doc_id, i, sha256(array_to_string(words[i:i + 12], ' ')) as words
    from (select doc_id, words, unnest(generate_series(1, len(words) - 12)) as i from d where len(words) >= 13)),
first as (select words, min(doc_id) as least from win group by 1),
gone as (
    select doc_id, list_distinct(flatten(list(generate_series(i, i + 12)))) as places
    from win join first using (words) where least < doc_id group by 1)
select doc_id, len(words) as n_words, coalesce(len(places), 0)::bigint as n_removed,
       sha256(case when places is null then array_to_string(words, ' ')
                   else coalesce(array_to_string(list_filter(words, lambda w, i: not list_contains(places, i)), ' '), '') end) as kept_sha256
from d left join gone using (doc_id)
"""


def statements() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op3_line_dedup": LINE_DEDUP,
        "op4_source_mixing": MIXING,
        "op8_sharding": SHARDING,
        "op9_document_fingerprints": FINGERPRINTS,
        "op10_license_scan": LICENSE_SCAN,
        "op12_lexical_search": SEARCH,
        "op13_substring_dedup": PASSAGES,
    }
