"""SQL counterparts of the queries of this folder, for DuckDB."""

from palimpsest.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _values(rows):
    return ", ".join(f"('{text}', '{label}')" for text, label in rows)

ORACLES = {
    "op1_exact_dedup": """
        with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents)
        select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size,
               doc_id = max(doc_id) over w as kept, text_sha256
        from d window w as (partition by text_sha256)
    """,
    "op3_url_filters": """
        with u as (
          select page_id, case when position('://' in url) > 0
                               then substr(url, position('://' in url) + 3) else '' end as rest
          from pages
        ), h as (
          select page_id,
                 translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
          from u
        ), r(rule, verdict) as (
          values ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')
        ), l(key) as (
          values ('cheap-pills.example.com/'), ('spam-farm.example.org/'), ('casino.example.com/'), ('casino.example.org/')
        ), f as (
          select page_id, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict
          from h, r
          where ('.' || host) like '%.' || split_part(rule, '/', 1)
            and starts_with(path, substr(rule, position('/' in rule)))
          group by page_id
        ), b as (
          select distinct page_id from h, l
          where ('.' || host) like '%.' || split_part(key, '/', 1)
            and starts_with(path, substr(key, position('/' in key)))
        )
        select h.page_id, host, path, f.rule,
               coalesce(f.verdict, case when b.page_id is not null then 'block' else 'allow' end) as verdict
        from h left join f using (page_id) left join b using (page_id)
    """,
    "op2_decontamination": f"""
        with d as (
          select doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '{WORD}') as w from documents
        ), i as (
          select item_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER_LOWER}), '{WORD}') as w from benchmark
        ), x as (
          select distinct item_id, least(len(w), 10) as n,
                 unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda k: array_to_string(w[k:k + least(len(w), 10) - 1], ' '))) as win
          from i where len(w) > 0
        ), p as (
          select doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') as win
          from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, (select distinct n from x) where len(w) >= n)
        ), m as (
          select distinct doc_id, k, n, item_id from p join x using (win, n)
        ), h as (
          select doc_id, count(distinct j) as n_hit from (select doc_id, unnest(range(k, k + n)) as j from m) group by 1
        ), a as (
          select doc_id, count(distinct item_id) as n_items,
                 string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from m group by 1
        )
        select d.doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from d left join h using (doc_id) left join a using (doc_id)
    """,
    "op9_license_scans": f"""
        with d as (
          select doc_id, translate(coalesce(text, ''), {UPPER_LOWER}) as t from documents
        ), w as (
          select doc_id, regexp_extract_all(t, '{WORD}') as w from d
        ), p(phrase, label) as (values {_values(PHRASES)}
        ), b as (
          select doc_id, label, unnest(range(0, len(w) - len(string_split(phrase, ' ')) + 1)) as k, w, string_split(phrase, ' ') as s
          from w, p where contains(' ' || array_to_string(w, ' ') || ' ', ' ' || phrase || ' ')
        ), f as (
          select doc_id, count(*) as n_base, min(k) as first_word, max(k) as last_word, list_sort(list(distinct label)) as base
          from b where w[k + 1:k + len(s)] = s group by doc_id
        ), t(text, label) as (values {_values(TEMPLATES)}
        ), l as (
          select doc_id, unnest(regexp_split_to_array(t, '[\\r\\n]+|[.!?;][\\x20\\t]+')) as block from d
        ), c as (
          select doc_id, label, len(list_intersect(regexp_extract_all(block, '{WORD}'), list_distinct(string_split(text, ' ')))) as shared,
                 len(list_distinct(string_split(text, ' '))) as n
          from l, t
        ), o as (
          select doc_id, list(distinct label) as own, max(shared / n) as share
          from c where shared >= ceil(round({THRESHOLD} * n, 9)) group by doc_id
        )
        select w.doc_id, len(w)::bigint as n_words, coalesce(n_base, 0)::bigint as n_base, first_word::bigint as first_word,
               last_word::bigint as last_word, coalesce(array_to_string(base, ','), '') as base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(own, [])))), ','), '') as labels,
               case when n_base > 0 then 1.0::double else coalesce(share, 0)::double end as score
        from w left join f using (doc_id) left join o using (doc_id)
    """,
}

#: CRC-32 of a short ASCII string, from the polynomial; ``steps`` is the table of its 256 remainders.
CRC_STEPS = """(select list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as steps)"""


def crc_sql(value: str) -> str:
    return f"""xor(4294967295::bigint, list_reduce(
        list_prepend(4294967295::bigint, list_transform(string_split({value}, ''), lambda ch: ord(ch)::bigint)),
        lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])))"""


#: Costs run backward over the rows, the trace forward; ``c`` holds the costs to go in the states nothing, s, u, a.
ORACLES["op12_conversation_repair"] = f"""
    with recursive raw as (
      select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
             {crc_sql("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as kind
      from conversations, {CRC_STEPS}
    ), damaged as (
      select conv_id, turn, case when kind = 4 then 'user' else role end as role,
             case when kind = 1 then '' when kind = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
             unnest(case when kind = 3 then [1, 2] else [1] end) as copy
      from raw where kind <> 0
    ), placed as (
      select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as i,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as solid
      from damaged
    ), judged as (
      select *, case when solid = '' then 'blank'
                     when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
                     when right(solid, 1) not in ('.', '!', '?') then 'truncated' else '' end as fault,
             left(role, 1) as initial, lag(left(role, 1)) over (partition by conv_id order by i) as before
      from placed
    ), rows as (
      select conv_id, i, role, text, initial, fault in ('blank', 'duplicate') as gone, (fault = 'truncated')::bigint as t from judged
    ), costs(conv_id, i, c) as (
      select conv_id, max(i) + 1, [0, 4, 2, 0]::bigint[] from rows group by conv_id
      union all
      select conv_id, i, [least(w[1], w[3] + 2, w[4] + 4), least(w[2], w[3] + 2, w[4] + 4), least(w[3], w[4] + 2), least(w[4], w[3] + 2)]
      from (
        select r.conv_id, r.i, case when gone then list_transform(c, lambda x: x + 3) else [
                 least(c[1] + 3, c[3] + 2 + t, case initial when 's' then c[2] + t when 'u' then c[3] + t else 1000000000 end),
                 least(c[2] + 3, c[3] + 2 + t, case when initial = 'u' then c[3] + t else 1000000000 end),
                 least(c[3] + 3, c[4] + 2 + t, case when initial = 'a' then c[4] + t else 1000000000 end),
                 least(c[4] + 3, c[3] + 2 + t, case when initial = 'u' then c[3] + t else 1000000000 end)] end as w
        from costs join rows r on r.conv_id is not distinct from costs.conv_id and r.i = costs.i - 1)
    ), ways as (
      select h.conv_id, h.i, h.c, a.c as n, r.role, r.text, r.initial, r.gone, r.t
      from costs h left join rows r on r.conv_id is not distinct from h.conv_id and r.i = h.i
      left join costs a on a.conv_id is not distinct from h.conv_id and a.i = h.i + 1
    ), trace(conv_id, i, s, audit, lines) as (
      select conv_id, 1, 1, '', []::varchar[] from rows where i = 1
      union all
      select conv_id, case when letter = 'I' then i else i + 1 end,
             case letter when 'D' then s when 'K' then kept else ahead end, audit || letter,
             case letter when 'D' then lines
                         when 'I' then list_append(lines, made || ':')
                         when 'K' then list_append(lines, role || ':' || text)
                         else list_append(lines, made || ':' || text) end
      from (
        select f.*, w.role, w.text, ahead, kept, case when f.s = 3 then 'assistant' else 'user' end as made,
               case when w.n[f.s] + 3 = w.c[f.s] then 'D'
                    when w.c[ahead] + 2 = w.c[f.s] then 'I'
                    when not w.gone and w.n[kept] + w.t = w.c[f.s] then 'K'
                    when not w.gone and w.n[ahead] + 2 + w.t = w.c[f.s] then 'R' end as letter
        from (
          select f.*, case when f.s = 3 then 4 else 3 end as ahead from trace f
        ) f join ways w on w.conv_id is not distinct from f.conv_id and w.i = f.i,
        lateral (select case when f.s = 1 and w.initial = 's' then 2 when f.s <> 3 and w.initial = 'u' then 3
                             when f.s = 3 and w.initial = 'a' then 4 end as kept) k
        )
      where letter is not null
    ), repaired as (
      select conv_id, arg_max(audit, (i, len(audit))) as audit, arg_max(lines, (i, len(audit))) as lines from trace group by conv_id
    ), counted as (
      select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
             count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
             count(*) filter (fault = 'truncated') as truncated,
             count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
      from judged group by conv_id
    )
    select e.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate,
           coalesce(truncated, 0)::bigint as truncated, coalesce(illegal, 0)::bigint as illegal, coalesce(c.c[1], 0)::bigint as cost,
           coalesce(r.audit, '') as audit, sha256(coalesce(array_to_string(r.lines, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id from conversations) e
    left join counted n on n.conv_id is not distinct from e.conv_id
    left join repaired r on r.conv_id is not distinct from e.conv_id
    left join costs c on c.conv_id is not distinct from e.conv_id and c.i = 1
"""
