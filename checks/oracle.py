"""The SQL each query is compared with, over the same whole tables."""

from __future__ import annotations

import os

VIEWS = {}

VIEWS["v_entity"] = """
select concat('http://vocab.test/Vocabulary#publication-',cast(page_id as string)) id,
       'ResearchPublication' as type, url access_url, cast(null as string) page_url from pages
union all
select concat('http://vocab.test/Vocabulary#dataset-',cast(p_partkey as string)), 'Dataset',
       cast(null as string),
       case when p_partkey%7=0 then null
            when p_partkey%5=0 then concat('http://example.com/',cast(p_partkey as string))
            else concat('http://data.test/',cast(p_partkey as string)) end from part"""

VIEWS["v_eid"] = """
select *, split_part(split_part(id,'#',2),'-',2) entity_id from v_entity"""

VIEWS["v_file"] = """
select concat('corpus_docs/pub/pdf/',cast(page_id as string),'.pdf') path,
       cast(case when page_id%11=0 then 0 else length(html) end as bigint) len
from pages where page_id%3<>0
union all
select concat('corpus_docs/pub/txt/',cast(page_id as string),'.txt'),
       case when page_id%10=0 then 0 else 100 end from pages where page_id%4=0
union all
select concat('corpus_docs/dat/',cast(p_partkey as string),
       case when p_partkey%2=0 then '.html' else '.pdf' end), 10
from part where p_partkey%3=0"""

VIEWS["v_stem"] = r"""
select path, len, regexp_extract(path,'([^/]+)\.[^./]+$',1) stem,
       split_part(path,'/',2) top, split_part(path,'/',3) kind from v_file"""

VIEWS["v_triple"] = """
select o_orderkey seq, concat('http://t.test/order/',cast(o_orderkey as string)) s,
       'http://t.test/placedBy' p, concat('http://t.test/customer/',cast(o_custkey as string)) o
from orders
union all
select 1000000000+c_custkey, concat('http://t.test/customer/',cast(c_custkey as string)),
       'http://t.test/inNation', concat('http://t.test/nation/',cast(c_nationkey as string))
from customer
union all
select 2000000000+n_nationkey, concat('http://t.test/nation/',cast(n_nationkey as string)),
       'http://t.test/name', n_name from nation"""

VIEWS["v_line"] = """
select doc_id, cast(unnest(range(len(l))) as int) line_no, unnest(l) as text
from (select doc_id, string_split(text,chr(10)) l from documents)"""

VIEWS["v_para_line"] = """
select doc_id, line_no, case when line_no%5=4 then '' when line_no%5=1 then concat(text,'-')
       else text end as text from v_line"""

VIEWS["v_element"] = r"""
select doc_id, cast(pos//6 as int) page_no, cast(pos as int) elem_no,
       case when m like '<h1>%' or pos%4=3 then 'heading' when pos%9=8 then 'list'
            else 'paragraph' end as type,
       regexp_replace(m,'<[^>]*>','','g') as text
from (select page_id doc_id, unnest(range(len(l))) pos, unnest(l) m
      from (select page_id, regexp_extract_all(html,'(?s)<(h1|p)>.*?</(?:h1|p)>') l from pages))"""

VIEWS["v_section"] = """
select *, sum(case when type='heading' then 1 else 0 end)
            over (partition by doc_id order by elem_no) sec_no from v_element"""

VIEWS["v_sec"] = """
select doc_id, cast(sec_no as bigint) sec_no,
       max(case when type='heading' then text end) title,
       string_agg(text||chr(10)||chr(10),'' order by elem_no) as text
from v_section where sec_no>=1 group by all"""

# Elements of the parse trees: words, every fifth spelled in characters.
VIEWS["v_word"] = """
select doc_id, cast(elem_no//6 as int) p, cast(elem_no%6 as int) e, elem_no, type,
       unnest(range(len(l))) w, unnest(l) word
from (select *, string_split(text,' ') l from v_element)"""

VIEWS["v_elem_text"] = """
select doc_id, p, e, elem_no, type,
       string_agg(case when w%5=4 then word else word||' ' end,'' order by w) as text
from v_word group by all"""

VIEWS["v_elem_sec"] = """
select *, sum(case when type='heading' then 1 else 0 end)
            over (partition by doc_id order by elem_no) sec_no from v_elem_text"""


def _white_space() -> str:
    codes = [c for c in range(0x3001) if chr(c).isspace()]
    return "||".join(f"chr({c})" for c in codes)


_STRIP = _white_space()

VIEWS["v_para"] = f"""
select doc_id, cast(par_no as int) par_no,
       replace(trim(string_agg(line,' ' order by line_no),{_STRIP}),'- ','')||chr(10) as text
from (select *, coalesce(sum(case when line='' then 1 else 0 end) over
             (partition by doc_id order by line_no rows between unbounded preceding and 1 preceding),0) par_no
      from (select doc_id, line_no, trim(text,{_STRIP}) line from v_para_line))
group by doc_id, par_no having max(case when line='' then 1 else 0 end)=1"""

def stop_words() -> dict[str, list[str]]:
    """Stop words by language, from the plain file beside this module."""
    lists: dict[str, list[str]] = {}
    with open(os.path.join(os.path.dirname(__file__), "stop_words.txt"), encoding="utf-8") as lines:
        for line in lines:
            word = line.rstrip("\n")
            if word.startswith("["):
                lists[word.strip("[]")] = found = []
            elif word and not word.startswith("#"):
                found.append(word)
    return lists


def stop_rows() -> str:
    """The stop words as SQL rows."""
    rows = [(code, w.replace("'", "''")) for code, words in stop_words().items() for w in words]
    return ",".join(f"('{code}','{w}')" for code, w in rows)


def token_views(source: str, keys: str) -> str:
    """Tokens, kept words and candidate phrases of ``source(keys, text, lang)``."""
    blanks = "chr(9),chr(10),chr(11),chr(12),chr(13)".split(",")
    spaced = "lower(text)"
    for blank in blanks:
        spaced = f"replace({spaced},{blank},' ')"
    return rf"""
stop(lang,w) as (values {stop_rows()}),
tok as materialized (
  select {keys}, lang, unnest(range(len(l))) pos, unnest(l) w
  from (select {keys}, coalesce(case when lang in ('fr','de','es') then lang end,'en') lang,
        [x for x in string_split(regexp_replace({spaced},'[^\p{{L}}\p{{N}} ]+',' '||chr(10)||' ','g'),' ')
         if x<>''] l
        from {source})),
kept as materialized (
  select {keys}, pos, w, row_number() over (partition by {keys} order by pos) i
  from tok where w<>chr(10) and not exists (select 1 from stop where stop.lang=tok.lang and stop.w=tok.w)),
run as materialized (
  select {keys}, min(i) i0, string_agg(w,' ' order by i) phrase
  from kept group by {keys}, pos-i)"""


def candidate_sql() -> str:
    return f"""with {token_views('documents','doc_id')}
select doc_id, cast(row_number() over (partition by doc_id order by i0)-1 as int) seq, phrase
from run"""


def textrank_sql(source: str, keys: str, k: int, rounds: int = 20, title: str = "") -> str:
    """The ranks with every round written out, in whole units of 1e-12."""
    on = " and ".join(f"{{0}}.{c}={{1}}.{c}" for c in keys.split(","))
    qk = lambda alias: ",".join(f"{alias}.{c}" for c in keys.split(","))
    parts = [
        token_views(source, keys),
        f"""pair as (select {qk('x')}, x.w a, y.w b from kept x join kept y
  on {on.format('x','y')} and y.i between x.i+1 and x.i+3 and x.w<>y.w)""",
        f"""edge as materialized (select {keys}, a, b from pair union select {keys}, b, a from pair)""",
        f"""node as materialized (select {qk('v')}, v.w, coalesce(g.deg,0) deg, 150000000000//n base,
         1000000000000//n start_r
  from (select distinct {keys}, w from kept) v
  join (select {keys}, count(distinct w) n from kept group by {keys}) c on {on.format('v','c')}
  left join (select {keys}, a, count(*) deg from edge group by {keys}, a) g
    on {on.format('v','g')} and g.a=v.w)""",
        f"r0 as materialized (select {keys}, w, deg, base, start_r r from node)",
    ]
    for t in range(1, rounds + 1):
        parts.append(f"""r{t} as materialized (
  select {qk('n')}, n.w, n.deg, n.base,
         cast(n.base + coalesce(s.s,0)*85//100 as bigint) r
  from node n left join (
    select {qk('e')}, e.a, cast(sum(x.r//x.deg) as bigint) s from edge e
    join r{t-1} x on {on.format('e','x')} and x.w=e.b group by {qk('e')}, e.a) s
  on {on.format('n','s')} and s.a=n.w)""")
    parts.append(f"""ph as materialized (select {keys}, phrase, count(*) cnt from run group by {keys}, phrase)""")
    parts.append(f"""sc as (select {qk('p')}, p.phrase, any_value(p.cnt) cnt,
    cast(sum(x.r)//count(*) as bigint) units
  from (select {keys}, phrase, cnt, unnest(string_split(phrase,' ')) w from ph) p
  join r{rounds} x on {on.format('p','x')} and x.w=p.w group by {qk('p')}, p.phrase)""")
    parts.append(f"""rk as (select *, row_number() over (partition by {keys} order by units desc, phrase) rk from sc)""")
    out = f"select {qk('rk')}{{}}, cast(rk as int) rk, phrase, cnt, units/1000000000000.0::double rank_score from rk"
    tail = out.format("") if not title else (
        out.format(", title") + f" join {source} src on {on.format('rk','src')}"
    )
    return "with " + ",\n".join(parts) + f"\n{tail} where rk<={k}"


def _with(sql: str) -> str:
    """Put the views a statement uses, and those they use, in front of it."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name in needed:
                continue
            if any(f"{lead}{name}" in text for lead in (" ", "\n", "(", ",")):
                import re

                if re.search(rf"\b{name}\b", text):
                    visit(VIEWS[name])
                    if name not in needed:
                        needed.append(name)

    visit(sql)
    if not needed:
        return sql
    head = ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed)
    body = sql.lstrip()
    if body.startswith("with "):
        return f"with {head},\n{body[5:]}"
    return f"with {head}\n{body}"


ORACLE_BODY = {
    "corpus_entities": """select id, type,
        case when type='Dataset' then null
             when split_part(id,'-',2)::bigint%4=0 then access_url||' '||access_url else access_url end access_urls,
        type='ResearchPublication' and split_part(id,'-',2)::bigint%4=0 access_is_list, page_url
        from v_entity""",
    "corpus_size": "select count(*) n from v_entity",
    "publications": "select id, type from v_entity where type='ResearchPublication'",
    "entity_ids": "select id, entity_id from v_eid",
    "access_urls": "select id, access_url url from v_entity",
    "duplicate_publications": """select cast(page_id as string) entity_id, url||' '||url access_urls
        from pages where page_id%4=0""",
    "page_urls": """select id, page_url url from v_entity
        where page_url is not null and page_url not like 'http://example.com%'""",
    "non_empty_files": "select path, len as length from v_file where len>0",
    "files_of_kind": "select path, len as length from v_file where path like '%.pdf'",
    "file_ids": "select distinct stem entity_id from v_stem",
    "id_difference": """select stem entity_id from v_stem where kind='pdf' and top='pub'
        except select stem from v_stem where kind='txt'""",
    "pending_publications": """select 'pdf' as type, entity_id, access_url url, 'pub/pdf/' path from v_eid
        where type='ResearchPublication'
          and entity_id not in (select stem from v_stem where top='pub' and kind='pdf')""",
    "all_publications": """select 'pdf' as type, entity_id, access_url url, 'pub/pdf/' path from v_eid
        where type='ResearchPublication'""",
    "pending_datasets": """select 'unknown' as type, entity_id, page_url url, 'dat/' path from v_eid
        where type='Dataset' and page_url is not null and page_url not like 'http://example.com%'
          and entity_id not in (select stem from v_stem where top='dat')""",
    "finished_publications": """select entity_id from v_eid where type='ResearchPublication'
          and entity_id in (select stem from v_stem where top='pub' and kind='pdf')""",
    "worklist": """select 'pdf' as type, entity_id, access_url url, 'pub/pdf/' path, 0 part from v_eid
        where type='ResearchPublication'
          and entity_id not in (select stem from v_stem where top='pub' and kind='pdf')
        union all
        select 'unknown', entity_id, page_url, 'dat/', 1 from v_eid
        where type='Dataset' and page_url is not null and page_url not like 'http://example.com%'
          and entity_id not in (select stem from v_stem where top='dat')""",
    "pending_conversions": """select stem entity_id from v_stem where top='pub' and kind='pdf' and len>0
        except select stem from v_stem where kind='txt' and len>0""",
    "pending_parses": """select stem entity_id from v_stem where top='pub' and kind='pdf'
        except select stem from v_stem where kind='txt'""",
    "stored_ids": "select distinct stem entity_id from v_stem where top='pub' and kind='pdf'",
    "pending_uploads": """select cast(page_id as string) entity_id,
          concat('resources/pub/pdf/',cast(page_id as string),'.pdf') path
        from pages where cast(page_id as string) not in
          (select stem from v_stem where top='pub' and kind='pdf')""",
    "missing_resources": """select type, entity_id from v_eid where type='ResearchPublication'
          and entity_id not in (select stem from v_stem where top='pub' and kind='pdf')
        union select type, entity_id from v_eid where type='Dataset'
          and entity_id not in (select stem from v_stem where top='dat')""",
    "resource_stats": """select type, count(*) total, count(*)-count(distinct miss) fetched, count(distinct miss) missing
        from (select type, case when entity_id not in
                (select stem from v_stem where (type='Dataset' and top='dat')
                   or (type<>'Dataset' and top='pub' and kind='pdf')) then entity_id end miss
              from v_eid) group by type""",
    "manifest": """select '2020-03-01' date, 'v1' as release,
          (select count(*) from (select cast(page_id as string) from pages
             union select stem from v_stem where top='pub' and kind='pdf')) uploaded_pdf,
          cast(0 as bigint) uploaded_json,
          (select count(*) from (select cast(page_id as string) from pages
             union select stem from v_stem where kind='txt')) uploaded_txt""",
    "manifest_lines": """select 0 line_no, 'date: 2020-03-01' as value
        union all select 1, 'release: v1'
        union all select 2, 'uploaded_pdf: '||count(*) from pages
        union all select 3, 'uploaded_json: 0'
        union all select 4, 'uploaded_txt: '||count(*) from pages""",
    "first_keys": "select path from v_file order by path limit 10",
    "url_parts": r"""select page_id, url, regexp_extract(url,'^([a-z]+)://',1) scheme,
        regexp_extract(url,'^[a-z]+://([^/?#]*)',1) host,
        case when strpos(url,'#')>0 then substr(url,strpos(url,'#')+1) else '' end fragment from pages""",
    "file_stems": r"""select path, stem,
        case when top='pub' then split_part(split_part(path,'/',4),'.pdf',1) else '' end key_id from v_stem""",
    "object_paths": """select concat('corpus_docs/pub/json/',cast(page_id as string),'.json') path from pages""",
    "split_lines": "select doc_id, line_no, text from v_line",
    "stripped_lines": f"select doc_id, line_no, trim(text,{_STRIP}) as text from v_para_line",
    "dehyphenated": f"""select doc_id,
        replace(trim(replace(replace(text,'e','- '),chr(10),' '),{_STRIP}),'- ','')||chr(10) as text from documents""",
    "resource_types": """select page_id, type, content_type,
        case when type<>'unknown' then type when content_type like '%text/html%' then 'html' else 'pdf' end resource_type
        from (select page_id, case page_id%4 when 0 then 'pdf' when 1 then 'html' else 'unknown' end as type,
              case when length(html)%2=0 then 'text/html; charset=utf-8' else 'application/pdf' end content_type
              from pages)""",
    "wrapped_tokens": r"""select doc_id,
        '"\"\\'||replace(replace(replace(replace(text,'\','\\'),'"','\"'),chr(10),'\n'),chr(13),'\r')||'"' token,
        concat('<http://t.test/',cast(doc_id as string),'>') iri from documents""",
    "pdf_heads": "select distinct page_id%16 bucket, page_id%2=0 is_pdf from pages",
    "pdf_flags": "select cast(page_id as string) path, page_id%2=0 is_pdf from pages",
    "iso_dates": "select o_orderkey, strftime(o_orderdate,'%Y-%m-%d') as day from orders",
    "json_documents": "select page_id, url, html body from pages",
    "paragraphs": "select doc_id, par_no, text from v_para",
    "paragraphs_from_lines": "select doc_id, par_no, text from v_para",
    "document_text": """select doc_id, string_agg(text,chr(10) order by par_no) as text from v_para group by doc_id""",
    "document_text_from_lines": """select doc_id, string_agg(text,chr(10) order by par_no) as text
        from v_para group by doc_id""",
    "sections": "select doc_id, sec_no, title, text from v_sec",
    "sections_with_titles": "select doc_id, sec_no, title, text from v_sec",
    "sections_without_preamble": """select doc_id, cast(sec_no as bigint) sec_no,
          max(case when type='heading' then text end) title,
          string_agg(text||chr(10)||chr(10),'' order by elem_no) as text
        from (select *, sum(case when type='heading' then 1 else 0 end)
                over (partition by doc_id order by elem_no) sec_no
              from (select * replace (case when elem_no=0 then 'paragraph' else type end as type) from v_element))
        where sec_no>=1 group by doc_id, sec_no""",
    "assigned_sections": "select doc_id, elem_no, cast(sec_no as bigint) sec_no from v_section",
    "text_elements": "select * from v_element where type<>'list'",
    "page_text": """select doc_id, string_agg(text||chr(10)||chr(10),'' order by elem_no) as text
        from v_element where type<>'list' group by doc_id""",
    "one_page_text": """select doc_id, string_agg(text||chr(10)||chr(10),'' order by elem_no) as text
        from v_element where type<>'list' and page_no=1 group by doc_id""",
    "flatten_tree": """
        select doc_id, concat(elem_no//6,'.',elem_no%6) path, type, cast(null as string) as text from v_element
        union all
        select doc_id, concat(elem_no//6,'.',elem_no%6,'.0'), 'paragraph', null from v_element where type='list'
        union all
        select doc_id, concat(elem_no//6,'.',elem_no%6,case when type='list' then '.0.0' else '.0' end), 'line', null
        from v_element
        union all
        select doc_id, concat(p,'.',e,case when type='list' then '.0.0.' else '.0.' end,w), 'word',
               case when w%5<>4 then word||' ' end from v_word
        union all
        select doc_id, concat(p,'.',e,case when type='list' then '.0.0.' else '.0.' end,w,'.',c), 'character', ch
        from (select *, unnest(range(length(word))) c, unnest(regexp_extract_all(word,'(?s).')) ch
              from v_word where w%5=4)""",
    "leaf_text": """select 'word' as type, count(*) n, cast(sum(length(word)+1) as bigint) chars from v_word where w%5<>4
        union all select 'character', cast(sum(length(word)) as bigint), cast(sum(length(word)) as bigint)
        from v_word where w%5=4""",
    "node_text": "select doc_id, p page_pos, e elem_pos, text from v_elem_text",
    "tree_elements": """select doc_id, p page_no, elem_no, type, text from v_elem_text""",
    "tree_sections": """select doc_id, cast(sec_no as int) sec_no,
          max(case when type='heading' then text end) title,
          string_agg(text||chr(10)||chr(10),'' order by elem_no) as text
        from v_elem_sec where sec_no>=1 group by doc_id, sec_no""",
    "tree_page_text": """select doc_id, coalesce(string_agg(text||chr(10)||chr(10),'' order by elem_no)
          filter (where type<>'list'),'') as text from v_elem_text where p=1 group by doc_id""",
    "candidate_phrases": candidate_sql(),
    "phrase_counts": f"""with {token_views('documents','doc_id')}
        select doc_id, phrase, count(*) cnt from run group by doc_id, phrase""",
    "textrank_docs": textrank_sql("documents", "doc_id", 20),
    "textrank_sections": textrank_sql(
        "(select doc_id, sec_no, title, text, 'en' lang from v_sec)", "doc_id,sec_no", 15, title="title"
    ),
    "rank_phrases": f"""with {token_views('documents','doc_id')}
        select *, cast(row_number() over (partition by doc_id order by cnt desc, phrase) as int) rk
        from (select doc_id, phrase, count(*) cnt, cast(count(*) as double) rank_score
              from run group by doc_id, phrase)""",
    "top_phrases": f"""with {token_views('documents','doc_id')}
        select * from (select *, cast(row_number() over (partition by doc_id order by cnt desc, phrase) as int) rk
        from (select doc_id, phrase, count(*) cnt, cast(count(*) as double) rank_score
              from run group by doc_id, phrase)) where rk<=20""",
    "top_section_phrases": f"""with {token_views("(select *, 'en' lang from v_sec)",'doc_id,sec_no')}
        select * from (select *, cast(row_number() over (partition by doc_id, sec_no order by cnt desc, phrase) as int) rk
        from (select doc_id, sec_no, phrase, count(*) cnt, cast(count(*) as double) rank_score
              from run group by doc_id, sec_no, phrase)) where rk<=15""",
    "unique_phrases": f"""with {token_views('documents','doc_id')}
        select doc_id, cast(min(n)+1 as int) rk, phrase, cast(length(phrase) as bigint) cnt,
               cast(max(n) as double) rank_score
        from (select *, row_number() over (partition by doc_id order by i0)-1 n from run)
        group by doc_id, phrase""",
    "distinct_triples": "select distinct s, p, o from v_triple",
    "touching": "select s, p, o from v_triple where s like '%nation/7' or o like '%nation/7'",
    "neighbourhood": "select distinct s, p, o from v_triple where s like '%customer/7' or o like '%customer/7'",
    "index_nodes": """select row_number() over (order by place)-1 id, name from
        (select name, min(place) place from (select s as name, seq*2 place from v_triple
           union all select o, seq*2+1 from v_triple) group by name)""",
    "node_edge_tables": """with n as (select row_number() over (order by place)-1 id, name from
        (select name, min(place) place from (select s as name, seq*2 place from v_triple
           union all select o, seq*2+1 from v_triple) group by name))
        select least(x.id,y.id) a, greatest(x.id,y.id) b, arg_max(p,seq) as label
        from v_triple t join n x on x.name=t.s join n y on y.name=t.o group by 1,2""",
    "collapsed_edges": """select least(x,y) a, greatest(x,y) b, arg_max(s,seq) as label
        from (select seq, s, string_split(o,'/')[-1] x, substr(s,1,22) y from v_triple) group by 1,2""",
    "compact_triples": """select
        case when s like 'http://t.test/customer/%' then 'cust:'||substr(s,24)
             when s like 'http://t.test/nation/%' then 'nat:'||substr(s,22) else 't:'||substr(s,15) end s,
        't:'||substr(p,15) p,
        case when o like 'http://t.test/customer/%' then 'cust:'||substr(o,24)
             when o like 'http://t.test/nation/%' then 'nat:'||substr(o,22) else o end o
        from v_triple""",
    "ntriples_lines": """select '<'||s||'> <'||p||'> '||case when o like 'http%' then '<'||o||'>'
        else '"'||o||'"' end||' .' as value from v_triple""",
    "ntriples_parsed": r"""select concat('http://t.test/doc/',cast(doc_id as string)) s, 'http://t.test/text' p,
        '"\n'||text o from documents""",
    "jsonld_nodes": """with c as (select
        case when s like 'http://t.test/customer/%' then 'cust:'||substr(s,24)
             when s like 'http://t.test/nation/%' then 'nat:'||substr(s,22) else 't:'||substr(s,15) end s,
        't:'||substr(p,15) p,
        case when o like 'http://t.test/customer/%' then 'cust:'||substr(o,24)
             when o like 'http://t.test/nation/%' then 'nat:'||substr(o,22) else o end o
        from v_triple)
        select '{"@id":"'||s||'",'||string_agg('"'||p||'":['||os||']',',' order by p)||'}' as value
        from (select s, p, string_agg('"'||o||'"',',' order by o) os from c group by s, p) group by s""",
    "version_history": """select conv_id doc_id, turn ver,
        row_number() over (partition by conv_id order by turn) pos from conversations""",
    "versions_of": "select conv_id doc_id, turn ver, text from conversations where conv_id=1",
    "version_pairs": """select * from (select conv_id doc_id, turn ver,
        lead(turn) over (partition by conv_id order by turn) next_ver from conversations)
        where next_ver is not null""",
    "version_diff": """with pr as (select *, lead(turn) over (partition by conv_id order by turn) nx from conversations),
        ln as (select conv_id, turn, unnest(string_split(text,chr(10))) as line from conversations),
        num as (select *, row_number() over (partition by conv_id, turn, line) occ from ln),
        l as (select pr.conv_id, pr.turn, pr.nx, line, occ from num join pr on pr.conv_id=num.conv_id
              and pr.turn=num.turn where nx is not null),
        r as (select pr.conv_id, pr.turn, pr.nx, line, occ from num join pr on pr.conv_id=num.conv_id
              and pr.nx=num.turn)
        select coalesce(l.conv_id,r.conv_id) doc_id, coalesce(l.turn,r.turn) ver, coalesce(l.nx,r.nx) next_ver,
               coalesce(l.line,r.line) as line,
               count(*) filter (where l.occ is not null and r.occ is not null) kept,
               count(*) filter (where r.occ is null) removed, count(*) filter (where l.occ is null) added
        from l full join r on l.conv_id=r.conv_id and l.turn=r.turn and l.line=r.line and l.occ=r.occ
        group by 1,2,3,4""",
    "line_changes": """with w as (select doc_id, unnest(string_split(replace(text,chr(10),' '),' ')) word,
              generate_subscripts(string_split(replace(text,chr(10),' '),' '),1) i from documents),
        l as (select doc_id, i, concat(i,':',word) line, count(*) over (partition by doc_id) n,
              (i>1 and i%5<>0) or count(*) over (partition by doc_id)=1 stays from w),
        a as (select *, coalesce(sum(stays::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding),0) gap,
              coalesce(sum((stays and i%7=0 and n>1)::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding),0) more,
              sum(stays::int) over (partition by doc_id) kept, sum((stays and i%7=0 and n>1)::int) over (partition by doc_id) every from l),
        r as (select doc_id, gap, case when stays then 2 else 0 end kind, i, case when stays then 'kept' else 'removed' end change,
              i old_no, case when stays then gap+more+1 end new_no, line from a
          union all select doc_id, gap+1, 1, i, 'added', null, gap+more+2, concat('new ',i) from a where stays and i%7=0 and n>1
          union all select doc_id, kept, 1, n+1, 'added', null, kept+every+1, line from a where i=1 and n>1)
        select doc_id, 1 ver, 2 next_ver, cast(row_number() over (partition by doc_id order by gap, kind, i) as int) "no",
               change, cast(old_no as int) old_no, cast(new_no as int) new_no, line from r""",
    "releases_by_time": "select concat('v',cast(o_orderkey as string)) tag, o_orderdate committed_at from orders",
    "latest_release": """select concat('v',cast(o_orderkey as string)) tag from orders
        order by o_orderdate desc, concat('v',cast(o_orderkey as string)) desc limit 1""",
    "attempt_outcomes": """select user_id task,
        case when bool_or(event_type<>'error') then 'ok' when count(*)<3 then 'retry' else 'gave_up' end outcome,
        count(*) trials,
        any_value(case when event_id=last_id then case when event_type='error'
           then concat('failed ',cast(event_id as string)) end end) last_status
        from (select *, max(event_id) over (partition by user_id) last_id from events) group by user_id""",
    "links": r"""select page_id, cast(row_number() over (partition by page_id order by pos)-1 as int) link_no,
        case when h like 'http%' then h else site||h end link
        from (select page_id, regexp_extract(url,'^([a-z]+://[^/?#]*)',1) site,
              unnest(range(len(l))) pos, unnest(l) h
              from (select page_id, url, regexp_extract_all(html,'<a href="([^"]*)"',1) l from pages))
        where not regexp_matches(h,'^(#|javascript:|mailto:|$)')""",
    "first_link": r"""select page_id, case when h like 'http%' then h else site||h end link
        from (select page_id, regexp_extract(url,'^([a-z]+://[^/?#]*)',1) site,
              [x for x in regexp_extract_all(html,'<a href="([^"]*)"',1)
               if not regexp_matches(x,'^(#|javascript:|mailto:|$)')][1] h from pages)""",
    "embedded_documents": r"""select page_id,
        case when page_id%3=0 then concat(regexp_extract(url,'^([a-z]+://[^/?#]*)',1),'/doc/',cast(page_id as string),'.pdf') end src,
        case when page_id%3<>0 then 'no embedded PDF' end status from pages""",
    "fetch_routes": r"""select page_id, url, case
          when regexp_extract(url,'^[a-z]+://([^/?#]*)',1)='www.sciencedirect.com' then 'links'
          when regexp_matches(url,'^[a-z]+://[^/?#]*onlinelibrary\.wiley\.com([/?#]|$)') then 'embed' else 'direct' end route
        from (select page_id, regexp_replace(regexp_replace(url,'//[^/]*example\.net','//www.sciencedirect.com'),
              '//[^/]*example\.org','//a.onlinelibrary.wiley.com') url from pages)""",
    "label_matches": r"""with t as (select l_orderkey doc_id, concat(cast(l_linenumber as string),' ans, ',
          cast(l_linenumber*7 as string),'% AB-',cast(100+l_linenumber as string),'-CD') as text from lineitem),
        m as (
          select doc_id, 'Car' as label, regexp_extract_all(text,'([A-Z]{2}\-[\d]{3}\-[A-Z]{2})') l from t
          union all select doc_id, 'Age', regexp_extract_all(text,'(\d+)[ -]*(ans|jarige)') from t
          union all select doc_id, 'Percent',
            regexp_extract_all(text,'([\-]?(\d)+[\.\,]*(\d)*)[ ]*(%|per|percent|pourcent|procent)') from t)
        select doc_id, label, cast(unnest(range(len(l))) as int) match_no, unnest(l) as match from m""",
    "clean_table": """select cast(o_orderkey as string) o_orderkey,
        coalesce(nullif(o_orderstatus,'F'),' ') status, coalesce(o_orderpriority,' ') o_orderpriority from orders""",
    "map_documents": "select doc_id, cast(len(string_split(text,' ')) as bigint) n_words from documents",
    "mentions": "",
    "section_mentions": "",
    "top_predictions": """select doc_id, dataset_id, score, cast(rk as int) rk from
        (select *, row_number() over (partition by doc_id order by score desc, dataset_id) rk from
          (select l_orderkey doc_id, l_partkey dataset_id, max(l_extendedprice) score from lineitem group by 1,2))
        where rk<=5""",
}

_SCORED = """with pr as (select l_orderkey doc_id, l_partkey dataset_id, max(l_extendedprice) score,
          bool_or(l_quantity>25) good from lineitem group by 1,2),
        rk as (select *, row_number() over (partition by doc_id order by score desc, dataset_id) rk from pr),
        lim as (select doc_id, count(*) d, least(count(*),5) cut from pr where good group by 1),
        sc as (select lim.doc_id, any_value(d) d, any_value(cut) cut, count(rk.rk) hits
          from lim left join rk on rk.doc_id=lim.doc_id and good and rk.rk<=cut group by 1)
        """
ORACLE_BODY["score_documents"] = _SCORED + "select doc_id, d, hits, hits/cut::double share from sc"
ORACLE_BODY["score_predictions"] = (
    _SCORED
    + "select count(*) documents, cast(sum(hits*1000000000000//cut) as bigint)/count(*)::double/1e12::double score from sc"
)


def _mentions(source: str, keys: str) -> str:
    words = r"regexp_extract_all(lower({}),'[\p{{L}}\p{{N}}]+')"
    qk = ",".join(f"d.{c}" for c in keys.split(","))
    return rf"""with nm as (select name_id, {words.format('name')} w from
          (select item_id name_id, text as name from benchmark union all
           select item_id+1000000, regexp_extract(text,'^([^ ]+ [^ ]+)',1) from benchmark)),
        n as (select distinct name_id, w, len(w) k, ' '||array_to_string(w,' ')||' ' s from nm where len(w)>0),
        d as materialized (select *, ' '||array_to_string(w,' ')||' ' s from
          (select {keys}, {words.format('text')} w from {source})),
        c as (select {qk}, n.name_id, d.w dw, n.w nw, k from d join n on contains(d.s,n.s)),
        p as (select {keys}, name_id, dw, nw, k, unnest(range(len(dw)-k+1)) i from c)
        select {keys}, name_id, count(*) n, cast(min(i) as int) first_pos from p
        where dw[i+1:i+k]=nw group by all"""


ORACLE_BODY["mentions"] = _mentions("documents", "doc_id")
ORACLE_BODY["section_mentions"] = _mentions("v_sec", "doc_id,sec_no")

# Queries that pass through files give what went in.
ORACLE_BODY["read_corpus"] = ORACLE_BODY["corpus_entities"]
ORACLE_BODY["todo_file"] = f"select type, entity_id, url, path from ({ORACLE_BODY['worklist']})"
ORACLE_BODY["stored_texts"] = "select doc_id, text, 'txt' kind from documents where length(text)>0"
ORACLE_BODY["stored_phrases"] = (
    f"select doc_id, phrase, cnt, rank_score from ({ORACLE_BODY['textrank_docs']})"
)
ORACLE_BODY["manifest_file"] = f"select value from ({ORACLE_BODY['manifest_lines']})"
ORACLE_BODY["triples_file"] = "select distinct s, p, o from v_triple"
ORACLE_BODY["jsonld_file"] = ORACLE_BODY["jsonld_nodes"]
ORACLE_BODY["textrank_by_rounds"] = ORACLE_BODY["textrank_docs"]
ORACLE_BODY["synced_files"] = """with d as (select distinct stem from v_stem where top='pub' and kind='pdf'),
        n as (select cast(page_id as string) entity_id, unnest(['pdf','txt']) kind from pages),
        m as (select * from n where kind='txt' or entity_id not in (select stem from d))
        select entity_id, kind, concat('resources/pub/',kind,'/',entity_id,'.',kind) path,
               (select count(*) from d) there, (select count(*) from m) as new from m"""
ORACLE_BODY["extracted_tables"] = """select concat('o',cast(o_orderkey as string)) as "order",
        coalesce(nullif(o_orderstatus,'F'),' ') status, coalesce(o_orderpriority,' ') o_orderpriority from orders"""
ORACLE_BODY["incremental_phrases"] = ORACLE_BODY["textrank_docs"]

ORACLE = {name: _with(sql) for name, sql in ORACLE_BODY.items()}
