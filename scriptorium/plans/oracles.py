"""SQL for each registered query, over the same tables, for another engine to run."""

from __future__ import annotations

from scriptorium.functions.replies import CATEGORIES
from scriptorium.operators.model import ALWAYS_SINGLE, TASKS
from scriptorium.plans.catalog import BATCH_SIZE, DEADLINE_SECONDS, DOCUMENT_TASKS, MAX_POLLS
from scriptorium.sources.documents import packaged_prompts

_PROMPTS = packaged_prompts()

_EXTENSIONS = """case doc_id % 8 when 0 then '.jpg' when 1 then '.JPEG' when 2 then '.png'
    when 3 then '.tif' when 4 then '.TIFF' when 5 then '.pdf' when 6 then '.txt'
    else '.tar.gz' end"""

VIEWS = {
    "v_files": f"""
  select doc_id, n_chars as length, concat(case when doc_id % 11 = 0 then '._' else '' end,
    source, '_', cast(doc_id % 13 as varchar), {_EXTENSIONS}) as name
  from documents""",
    "v_names": r"""
  select doc_id, name,
    case when regexp_matches(name, '^\.*[^.].*\.[^.]*$')
         then regexp_extract(name, '^(\.*[^.].*)\.[^.]*$', 1) else name end as base_name,
    lower(regexp_extract(name, '^\.*[^.].*(\.[^.]*)$', 1)) as ext
  from v_files""",
    "v_supported": r"""
  select * from v_names where not starts_with(name, '._')
    and regexp_matches(lower(name), '\.(jpg|jpeg|pdf|png|tif|tiff)$')""",
    "v_lines": r"""
  select doc_id, cast(floor(pos / 5) as int) + 1 as page, cast(pos as int) as line_no,
    line as text
  from (select doc_id, unnest(range(len(string_split(text, chr(10))))) as pos,
          unnest(string_split(text, chr(10))) as line from documents)""",
    "v_blocks": """
  select doc_id, page, line_no, -1 as word_no, 'LINE' as block_type, text,
    cast(99.0 as double) as confidence from v_lines
  union all
  select doc_id, page, line_no, cast(pos as int), 'WORD', word,
    cast(50 + (length(word) * 7 + pos) % 50 as double)
  from (select doc_id, page, line_no, unnest(range(len(string_split(text, ' ')))) as pos,
          unnest(string_split(text, ' ')) as word from v_lines) where word <> ''
  union all
  select distinct doc_id, page, -1, -1, 'PAGE', cast(null as varchar), cast(null as double)
  from v_lines""",
    "v_responses": """
  select c_custkey as request_id, case c_custkey % 10
    when 0 then concat('{"People":["', c_name, '"],"Productions":[],"Companies":["',
      c_mktsegment, '"],"Theaters":[],"Dates":["1920"]}')
    when 1 then '{"People":["x"]}'
    when 2 then '{"People":["x","y"],"Productions":[],"Companies":[],"Theaters":[],"Dates":[],"Extra":1}'
    when 3 then '{"People":["x",1],"Productions":[],"Companies":[],"Theaters":[],"Dates":[]}'
    when 4 then '["letter one","letter two"]'
    when 5 then 'not json'
    when 6 then '["letter one"] trailing note'
    when 7 then ''
    when 8 then '["letter one",2]'
    else '{"People":null,"Productions":[],"Companies":[],"Theaters":[],"Dates":[]}' end as response
  from customer""",
    "v_letters": """
  select conv_id, concat(
    case conv_id % 4 when 0 then concat(cast(conv_id as varchar), chr(10))
      when 1 then concat('Page ', cast(conv_id as varchar), chr(10))
      when 2 then concat('  +', cast(conv_id as varchar), ' ', chr(10)) else '' end,
    string_agg(concat('Dear Sir:', chr(10), text, chr(10), 'Yours truly,', chr(10), 'C', conv_id,
      chr(10), chr(10)), '' order by turn)) as body
  from conversations group by conv_id""",
    "v_entity_docs": """
  select o_orderkey as doc_id, c_name, n_name, cast(cast(o_orderdate as date) as varchar) as day
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey""",
    "v_poll": """
  select user_id as job_id, event_id, ts, case event_type when 'purchase' then 'SUCCEEDED'
    when 'error' then 'FAILED' else 'IN_PROGRESS' end as status
  from events""",
    "v_outcomes": f"""
  select job_id,
    coalesce(min_by(status, poll_no) filter (status in ('SUCCEEDED', 'FAILED')),
      'TIMED_OUT') as outcome,
    cast(coalesce(min(poll_no) filter (status in ('SUCCEEDED', 'FAILED')), {MAX_POLLS})
      as bigint) as polls
  from (select *, row_number() over (partition by job_id order by ts, event_id) as poll_no
        from v_poll) where poll_no <= {MAX_POLLS} group by job_id""",
    "v_pairs": """
  select doc_id, replace(text, 'th', 'tb') as raw, text as target,
    case when doc_id % 5 = 0 then null when doc_id % 5 = 1 then '' else text end as corrected
  from documents""",
    "v_turns": """
  select concat(conv_id, '-', turn) as doc_id, text from conversations""",
    "v_entities": """
  select l_orderkey as doc_id, cast(l_linenumber as bigint) as ord, 'Productions' as category,
    p_name as entity from lineitem join part on l_partkey = p_partkey
  union all select l_orderkey, l_linenumber, 'Companies', s_name
    from lineitem join supplier on l_suppkey = s_suppkey
  union all select o_orderkey, 1, 'People', c_name
    from orders join customer on o_custkey = c_custkey
  union all select o_orderkey, 1, 'Theaters', n_name
    from orders join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey
  union all select o_orderkey, 1, 'Dates', cast(cast(o_orderdate as date) as varchar)
    from orders""",
    "v_knowledge": """
  select 'Productions' as category, p_name as entity,
    max(concat(p_type, ' / ', p_brand)) as explanation from part group by p_name
  union all select 'Companies', s_name, max(concat('supplier ', n_name))
    from supplier join nation on s_nationkey = n_nationkey group by s_name
  union all select 'People', c_name, max(c_mktsegment) from customer group by c_name
  union all select 'Theaters', n_name, max(r_name)
    from nation join region on n_regionkey = r_regionkey group by n_name""",
    "v_explained": """
  select e.doc_id, e.ord, e.category, e.entity, k.explanation
  from v_entities e left join v_knowledge k on e.category = k.category and e.entity = k.entity
  where e.category <> 'Dates'""",
    "v_prompts": "select * from (values " + ", ".join(
        "('{}', '{}')".format(t, _PROMPTS[t].replace("'", "''")) for t in TASKS)
    + ") as p(task, prompt)",
    "v_tasks": "select doc_id, text, unnest([" + ", ".join(f"'{t}'" for t in DOCUMENT_TASKS)
    + "]) as task from documents",
}

# Letters of (doc_id, text) rows of a view called v_texts.
VIEWS["v_marked"] = r"""
  select doc_id, text, pos, line, trim(line, chr(9) || ' ') = '' as blank,
    regexp_matches(line, '^(Sincerely yours|Yours truly|Yours sincerely)') as signs,
    regexp_matches(line, '^(Dear|Friend|Gentlemen)') as greets
  from (select doc_id, text, unnest(range(len(string_split(text, chr(10))))) as pos,
          unnest(string_split(text, chr(10))) as line from v_texts)"""
VIEWS["v_closing"] = """
  select *, case when blank and last_sign > coalesce(last_blank, -1) then 1 else 0 end as closing
  from (select *,
      max(case when signs then pos end) over before_it as last_sign,
      max(case when blank then pos end) over before_it as last_blank
    from v_marked window before_it as (partition by doc_id order by pos
      rows between unbounded preceding and 1 preceding))"""
VIEWS["v_segments"] = """
  select *, coalesce(sum(closing) over (partition by doc_id order by pos
    rows between unbounded preceding and 1 preceding), 0) as segment
  from v_closing"""
VIEWS["v_numbered"] = """
  select doc_id, segment, greatest(1, sum(has_greeting) over (partition by doc_id
    order by segment)) as letter_no
  from (select doc_id, segment, max(case when greets then 1 else 0 end) as has_greeting
        from v_segments group by doc_id, segment)"""
VIEWS["v_split"] = """
  select doc_id, cast(letter_no as bigint) as letter_no,
    string_agg(line, chr(10) order by pos) as letter
  from v_segments join v_numbered using (doc_id, segment) where text <> ''
  group by doc_id, letter_no"""
VIEWS["v_page_numbers"] = r"""
  select doc_id, try_cast(replace(nullif(regexp_extract(string_split(text, chr(10))[1],
    '^\s*([+-]?[0-9]+(_[0-9]+)*)\s*$', 1), ''), '_', '') as bigint) as page_number
  from v_texts"""

# Token pairs of (marked) texts of a view called v_aligned, of which the raw text was made: the mark chr(1)
# stands where two words were read as one, so that what belongs together is known. The lexicon they give.
_BARE = r"regexp_replace({}, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')"
VIEWS["v_lexicon"] = f"""
  select wrong, arg_min(fixed, (-n, fixed)) as fixed
  from (select {_BARE.format("replace(replace(t, 'th', 'tb'), chr(1), '_')")} as wrong,
          {_BARE.format("replace(t, chr(1), ' ')")} as fixed, count(*) as n
        from (select unnest(string_split(replace(marked, chr(10), ' '), ' ')) as t from v_aligned) group by all)
  where wrong <> '' group by wrong having arg_min(fixed, (-n, fixed)) <> wrong"""
# Tokens of (doc_id, raw) rows of a view called v_raw, corrected by the lexicon and joined again.
VIEWS["v_tokens"] = f"""
  select *, {_BARE.format("token")} as word
  from (select doc_id, line_no, unnest(range(len(string_split(line, ' ')))) as pos,
          unnest(string_split(line, ' ')) as token
        from (select doc_id, unnest(range(len(string_split(raw, chr(10))))) as line_no,
                unnest(string_split(raw, chr(10))) as line from v_raw))"""
VIEWS["v_repaired"] = r"""
  select doc_id, line_no, pos, case
      when x.fixed is not null then concat(regexp_extract(token, '^[^\p{L}\p{N}]*'), x.fixed,
        regexp_extract(token, '[^\p{L}\p{N}]*$'))
      when l.fixed is not null then concat(regexp_extract(token, '^[^\p{L}\p{N}]*'),
        case when word[1] <> lower(word[1]) then concat(upper(l.fixed[1]), l.fixed[2:])
             else l.fixed end,
        regexp_extract(token, '[^\p{L}\p{N}]*$'))
      else token end as token
  from v_tokens left join v_lexicon x on x.wrong = word
  left join v_lexicon l on l.wrong = lower(word) and l.wrong <> word"""
VIEWS["v_corrected"] = """
  select doc_id, string_agg(line, chr(10) order by line_no) as text
  from (select doc_id, line_no, string_agg(token, ' ' order by pos) as line
        from v_repaired group by doc_id, line_no) group by doc_id"""


def _with(names, body, **more):
    """SQL that defines the named views in the given order, then the body."""
    defined = {**VIEWS, **more}
    views = ",\n".join(f"{n} as ({defined[n]})" for n in names.split())
    return f"with {views}\n{body}" if views else body


def _lists(source, key, names=CATEGORIES):
    columns = ", ".join(
        f"coalesce(string_agg(entity, '|' order by ord, entity) filter (category = '{c}'), '')"
        f" as {c.lower()}" for c in names)
    return f"select {key}, {columns} from {source} group by {key}"


_SPLIT = "v_marked v_closing v_segments v_numbered v_split v_page_numbers"
_LETTER_TEXTS = "select conv_id as doc_id, body as text from v_letters"
_SPLIT_LETTERS = _with(f"v_letters v_texts {_SPLIT}", """
select doc_id as conv_id, page_number, letter_no, letter
from v_split join v_page_numbers using (doc_id)""", v_texts=_LETTER_TEXTS)

_RUN = {
    "v_jobs": """
  select conv_id as doc_id, coalesce(any_value(outcome), 'SUCCEEDED') as outcome, count(*) as turns
  from conversations left join v_outcomes on conv_id = job_id group by conv_id""",
    "v_aligned": "select text as marked from conversations",
    "v_raw": """
  select conv_id as doc_id, replace(body, 'th', 'tb') as raw
  from v_letters join v_jobs on conv_id = doc_id where outcome = 'SUCCEEDED'""",
    "v_texts": "select * from v_corrected",
    "v_people": f"""
  select distinct on (t.doc_id, j.doc_id) t.doc_id, concat('C', j.doc_id) as entity,
    concat('wrote ', j.turns, ' letters') as explanation, min(t.place) over (partition by t.doc_id,
      j.doc_id) as first_at
  from (select doc_id, line_no * 1000000 + pos as place, lower(word) as word from (
      select doc_id, line_no, pos, {_BARE.format("token")} as word from v_repaired)) t
  join v_jobs j on t.word = concat('c', j.doc_id)""",
}
_RUN_VIEWS = ("v_poll v_outcomes v_letters v_jobs v_aligned v_lexicon v_raw v_tokens v_repaired v_corrected "
              f"v_texts {_SPLIT} v_people")

# Non-ASCII letters of the tables, as single bytes: the engine measures distances in bytes.
_LETTERS = "ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü"
_BYTES = " || ".join(f"chr({n})" for n in [*range(1, 9), *range(14, 32)][:len(_LETTERS)])


def _in_bytes(text):
    return f"translate({text}, '{_LETTERS}', {_BYTES})"


def _distance(a, b):
    return f"levenshtein({_in_bytes(a)}, {_in_bytes(b)})"


def _similarity(a, b, distance="distance"):
    return (f"round(case when greatest(length({a}), length({b})) = 0 then 1.0 else "
            f"1 - {distance} / greatest(length({a}), length({b})) end, 6)")


def _is_string_list(path):
    return (f"coalesce(json_type(response, '{path}') = 'ARRAY' and len(list_filter("
            f"json_extract(response, '{path}[*]'), lambda x: json_type(x) <> 'VARCHAR')) = 0, false)")


_ENTITIES_VALID = " and ".join(_is_string_list(f"$.{c}") for c in CATEGORIES)
_ENTITY_LISTS = ", ".join(
    f"case status when 'parsed' then coalesce(array_to_string(json_extract_string(response, "
    f"'$.{c}[*]'), '|'), '') when 'defaulted' then '' end as {c.lower()}" for c in CATEGORIES)

_MODEL_LISTS = ", ".join(
    f"case status when 'parsed' then coalesce(array_to_string(json_extract_string(response, "
    f"'$.{c}[*]'), '|'), '') else '' end as {c.lower()}" for c in CATEGORIES)
_CHECKED = f"""
  select request_id, response, case when not json_valid(response) then 'defaulted'
    when {_ENTITIES_VALID} then 'parsed' else 'invalid' end as status
  from v_responses"""

_SYSTEM = "case when single then null else prompt end"
_USER = "case when single then concat(prompt, chr(10), 'Text:', chr(10), text) else text end"

_TERMINAL_ELAPSED = """concat(cast(floor(s / 3600) as bigint), 'h ',
    cast(floor((s % 3600) / 60) as bigint), 'm ', cast(s % 60 as bigint), 's')"""

ORACLES = {
    "a1_scan_documents": _with(
        "v_letters", "select conv_id, cast(strlen(body) as bigint) as length from v_letters"),
    "a2_read_ocr_pages": _with("v_lines v_blocks", """
select doc_id as job_id, cast(page - 1 as bigint) as page_ord,
  cast(row_number() over (partition by doc_id, page
    order by case block_type when 'PAGE' then 0 when 'LINE' then 1 else 2 end, line_no, word_no)
    - 1 as bigint) as block_ord, block_type, text, confidence,
  cast(greatest(word_no, 0) as double) as box_left, cast(greatest(line_no, 0) as double) as box_top,
  cast(coalesce(length(text), 0) as double) as box_width, cast(1 as double) as box_height
from v_blocks"""),
    "a2_incomplete_jobs": _with("v_lines v_poll v_outcomes", """
select doc_id, 'FAILED' as outcome, case when outcome = 'FAILED' then 'failed' else 'incomplete_pages' end as reason
from (select doc_id, max(page) as n_pages from v_lines group by doc_id)
left join v_outcomes on doc_id = job_id where outcome = 'FAILED' or n_pages >= 7"""),
    "a2_assemble_pages": """
select doc_id, text as raw_text, cast(len(string_split(text, chr(10))) as bigint) as n_lines
from documents""",
    "a3_read_layout_pages": _with("v_lines", "select doc_id, page, line_no, text from v_lines"),
    "a4_read_text": _with("v_letters", "select conv_id, body as text from v_letters"),
    "a6_write_text": "select doc_id, text as raw_text from documents",
    "a7_write_json": _SPLIT_LETTERS,
    "b1_is_supported_file": _with("v_files v_names v_supported",
                                  "select doc_id, name from v_supported"),
    "b2_derive_paths": _with("v_files v_names", """
select doc_id, name, base_name, concat('input/', name) as path_to_file,
  concat('tmp/', base_name, '.pdf') as pdf_file, concat(base_name, '.pdf') as s3_pdf_key,
  concat('output/', base_name) as doc_output_dir from v_names"""),
    "b3_lower_extension": _with("v_files v_names", "select doc_id, name, ext from v_names"),
    "b4_route_preparation": _with("v_files v_names", """
select doc_id, 'aws' as provider, case when ext = '.pdf' then 'pass' else 'convert' end as action,
  case when ext = '.pdf' then concat('input/', name) else concat('tmp/', base_name, '.pdf') end
    as prepared_path from v_names
union all
select doc_id, 'azure', case when ext in ('.jpg', '.jpeg', '.png', '.tif', '.tiff') then 'resize'
    else 'convert' end,
  case when ext in ('.jpg', '.jpeg', '.png', '.tif', '.tiff')
    then concat('tmp/', base_name, '_resized', ext) else concat('tmp/', base_name, '.pdf') end
from v_names"""),
    "b5_guess_content_type": _with("v_files v_names", """
select doc_id, prepared_path,
  case when ext in ('.jpg', '.jpeg') then 'image/jpeg' when ext = '.png' then 'image/png'
    when ext in ('.tif', '.tiff') then 'image/tiff' else 'application/pdf' end as content_type
from (select *, case when ext in ('.jpg', '.jpeg', '.png', '.tif', '.tiff')
    then concat('tmp/', base_name, '_resized', ext) else concat('tmp/', base_name, '.pdf') end
    as prepared_path from v_names)"""),
    "b6_split_blocks": _with("v_lines v_blocks", """
select doc_id, page, line_no, word_no, lower(block_type) as level, text,
  case when block_type = 'WORD' then confidence end as confidence
from v_blocks where block_type in ('LINE', 'WORD')"""),
    "b7_effective_text": _with(
        "v_pairs", "select doc_id, coalesce(corrected, raw) as text from v_pairs"),
    "b8_failed_documents": _with("v_poll v_outcomes", """
select job_id, outcome, case outcome when 'TIMED_OUT' then 'timeout' else 'job_failed' end as reason
from v_outcomes where outcome <> 'SUCCEEDED'"""),
    "b9_warn_empty_ocr": _with("v_poll v_outcomes", """
select doc_id from documents join v_outcomes on doc_id = job_id where outcome <> 'SUCCEEDED'"""),
    "d1_handoff": _with("v_files v_names v_supported", """
select p.base_name, p.name, p.doc_id, j.job_id,
  case when j.job_id is null then 'not_submitted' else 'ready' end as state
from (select base_name, name, doc_id from v_supported
      qualify row_number() over (partition by base_name order by name desc, doc_id desc) = 1) p
left join (select base_name, max(concat('job-', doc_id)) as job_id from v_names
           where doc_id in (select doc_id from labels) group by base_name) j
  on p.base_name = j.base_name"""),
    "d2_attach_prompt": _with("v_prompts v_tasks", """
select doc_id, t.task, prompt from v_tasks t join v_prompts p on t.task = p.task"""),
    "d3_attach_responses": _with("v_responses", """
select request_id, case when answered then response end as response,
  case when not answered then 'no response' end as error
from (select *, request_id in (select o_custkey from orders) as answered from v_responses)"""),
    "d4_attach_explanations": _with("v_entities v_knowledge", """
select e.doc_id, e.category, e.ord, e.entity, k.explanation from v_entities e
left join v_knowledge k on e.category = k.category and e.entity = k.entity"""),
    "e1_assemble_raw_text": """
select doc_id, text as raw_text, cast(len(string_split(text, chr(10))) as bigint) as n_lines
from documents""",
    "e2_collect_boxes": _with("v_lines v_blocks", """
select doc_id, count(*) as n_boxes, string_agg(concat(text, ':', cast(confidence as int), ':',
  word_no, ':', line_no, ':', length(text), ':1'), ' ' order by page, line_no, word_no) as boxes
from v_blocks where block_type = 'WORD' group by doc_id"""),
    "e3_last_wins_by_key": _with("v_files v_names", """
select base_name, name, doc_id, case when row_number() over (partition by base_name
  order by name desc, doc_id desc) = 1 then 'kept' else 'superseded' end as state from v_names"""),
    "e4_build_entity_record": _with("v_entities", _lists("v_entities", "doc_id")),
    "e5_build_explanation_maps": _with("v_entities v_knowledge v_explained", """
select doc_id, category, entity, concat(max_by(explanation, ord), ' at ', max(ord)) as explanation
from v_explained where explanation is not null group by doc_id, category, entity"""),
    "e6_run_summary": _with("v_poll v_outcomes", f"""
select n_files, n_batches, batch_size, n_success, n_failed, {_TERMINAL_ELAPSED} as elapsed
from (select count(*) as n_files, cast(ceil(count(*) / {BATCH_SIZE}) as bigint) as n_batches,
    cast({BATCH_SIZE} as bigint) as batch_size,
    count(*) filter (outcome = 'SUCCEEDED') as n_success,
    count(*) filter (outcome <> 'SUCCEEDED') as n_failed,
    (select cast(floor(epoch(max(ts))) - floor(epoch(min(ts))) as bigint) from v_poll) as s
  from v_outcomes)"""),
    "f1_assign_batches": _with("v_files v_names v_supported", f"""
select doc_id, name, cast(floor((row_number() over (order by name, doc_id) - 1) / {BATCH_SIZE})
  as bigint) as batch_id from v_supported"""),
    "f2_number_pages": _with("v_lines", """
select doc_id, page, string_agg(text, chr(10) order by line_no) as page_text
from v_lines group by doc_id, page"""),
    "f3_first_terminal_status": _with("v_poll v_outcomes", "select * from v_outcomes"),
    "g1_unpivot_entities": _with("v_entities", """
select doc_id, category, row_number() over (partition by doc_id, category order by ord, entity)
  as ord, entity from v_entities where category <> 'Dates'"""),
    "g2_distinct_requests": _with("v_entities", """
select distinct category, entity from v_entities where category <> 'Dates'"""),
    "h1_py_strip": "select doc_id, trim(text, ' ' || chr(10)) as stripped from documents",
    "h2_parse_page_number": _with("v_letters v_texts v_page_numbers", """
select doc_id as conv_id, page_number from v_page_numbers""", v_texts=_LETTER_TEXTS),
    "h3_strict_json": _with("v_responses", """
select request_id, coalesce(json_valid(response), false) as is_json from v_responses"""),
    "h4_validate_entities": _with("v_responses v_checked", f"""
select request_id, status, {_ENTITY_LISTS} from v_checked""", v_checked=_CHECKED),
    "h5_parse_letters": _with("v_responses", f"""
select request_id, case when not json_valid(response) then 'whole_text'
    when json_type(response) <> 'ARRAY' then 'whole_text'
    when {_is_string_list("$")} then 'parsed' else 'failed' end as status,
  case when not json_valid(response) then concat('full text ', request_id)
    when json_type(response) <> 'ARRAY' then concat('full text ', request_id)
    when {_is_string_list("$")} then array_to_string(json_extract_string(response, '$[*]'), '|')
    end as letters
from v_responses"""),
    "h6_render_prompt": _with("v_prompts v_tasks", f"""
select doc_id, task, layout, system, cast(length(user_text) as bigint) as user_chars,
  sha256(concat_ws(chr(1), 'echo', task, system, user_text)) as request_id
from (select *, {_SYSTEM} as system, {_USER} as user_text
  from (select doc_id, t.task, layout, text, prompt,
      layout = 'single_user' or t.task in ({", ".join(f"'{t}'" for t in ALWAYS_SINGLE)}) as single
    from v_tasks t join v_prompts p on t.task = p.task
    cross join (values ('system_and_user'), ('single_user')) as l(layout)))"""),
    "h7_to_json_record": """
select doc_id, cast(json_object('doc_id', doc_id, 'lang', lang, 'source', source, 'text', text)
  as varchar) as record from documents""",
    "h8_rewrite_suffix": _with("v_files v_names", """
select doc_id, concat(base_name, '.combined_output.json') as path from v_names"""),
    "h9_format_elapsed": _with("v_poll", f"""
select event_id, {_TERMINAL_ELAPSED} as elapsed
from (select event_id, cast(floor(epoch(ts)) as bigint) - 1704067200 as s from v_poll)"""),
    "h10_format_run_stamp": _with("v_poll", """
select event_id, strftime(ts, '%m-%d-%Y_%H-%M-%S') as stamp from v_poll"""),
    "h11_split_lines": """
select doc_id, cast(unnest(range(len(lines))) as int) as line_no, unnest(lines) as line
from (select doc_id, string_split(replace(text, '. ', '.' || chr(10)), chr(10)) as lines
      from documents)""",
    "i1_correct_text": _with("v_pairs v_aligned v_lexicon v_raw v_tokens v_repaired v_corrected", """
select doc_id, text as corrected_text from v_corrected""",
                             v_aligned="select replace(target, ' and ', ' and' || chr(1)) as marked from v_pairs",
                             v_raw="select doc_id, replace(raw, ' and ', ' and_') as raw from v_pairs"),
    "i1_aligned_words": """
select coalesce(sum(len(list_filter(string_split(replace(replace(text, ' and ', ' and_'), chr(10), ' '), ' '),
    lambda w: w <> ''))), 0)::bigint as words, 1.0::double as aligned from documents""",
    "a5_read_prompts": _with("v_prompts", """
select lang, task, concat(prompt, ' Language: ', lang, ', texts: ', n) as prompt
from v_prompts, (select lang, count(*) as n from documents where lang is not null group by lang)"""),
    "i1_corpus_lexicon": f"""
with v_counted as (
  select word, count(*) as n from (select {_BARE.format("token")} as word
    from (select unnest(string_split(replace(text, chr(10), ' '), ' ')) as token from documents))
  where word <> '' group by word),
v_bytes as (select *, {_in_bytes("word")} as b from v_counted)
select r.word as wrong, arg_min(g.word, (-g.n, g.word)) as "right"
from v_bytes r join v_bytes g on r.b[1] = g.b[1] and abs(length(r.b) - length(g.b)) <= 1
where r.n < 5 and length(r.word) >= 4 and g.n >= 5 and levenshtein(r.b, g.b) <= 1
group by r.word""",
    "i2_extract_entities": _with("v_entity_docs", """
select doc_id, c_name as people, '' as productions, '' as companies, n_name as theaters,
  day as dates from v_entity_docs"""),
    "i3_explain_entities": _with("v_entities v_knowledge v_explained", """
select distinct doc_id, category, entity, explanation from v_explained
where explanation is not null"""),
    "i4_split_letters": _SPLIT_LETTERS,
    "i5_document_run": _with(_RUN_VIEWS, """
select doc_id, 'SUCCEEDED' as status, cast(null as varchar) as reason,
  'output/raw_text' as raw_path, 'output/corrected' as corrected_path, 'output/combined' as combined_path,
  cast(len(string_split(text, chr(10))) as bigint) as n_lines, page_number,
  coalesce((select count(*) from v_people p where p.doc_id = t.doc_id), 0) as n_entities,
  (select count(*) from v_split s where s.doc_id = t.doc_id) as n_letters
from v_texts t join v_page_numbers using (doc_id)
union all
select doc_id, 'FAILED', case outcome when 'TIMED_OUT' then 'timeout' else 'job_failed' end,
  null, null, null, null, null, null, null
from v_jobs where outcome <> 'SUCCEEDED'""", **_RUN),
    "i5_run_failures": """
select conv_id as doc_id, case conv_id % 4 when 1 then 'FAILED' when 2 then 'FAILED' else 'SUCCEEDED' end as status,
  case conv_id % 4 when 1 then 'failed: correct_text, split_letters' when 2 then 'failed: extract_entities' end as reason,
  case conv_id % 4 when 1 then 0 when 3 then 1 else count(*) end as n_letters
from conversations group by conv_id""",
    "i5_run_letters": _with(_RUN_VIEWS, """
select doc_id, page_number, letter_no, letter from v_split join v_page_numbers using (doc_id)""",
                            **_RUN),
    "i5_run_explanations": _with(_RUN_VIEWS, """
select doc_id, 'People' as category, row_number() over (partition by doc_id order by first_at)
    as ord,
  entity, explanation from v_people""", **_RUN),
    "i6_apply_model": """
select doc_id, trim(text, ' ' || chr(10)) as response, cast(null as varchar) as error
from documents""",
    "i1_model_correction": """
select doc_id, case when not contains(text, '|') then trim(replace(replace(text, 'th', 'tb'), 'tb', 'th'),
    ' ' || chr(10)) end as corrected_text,
  case when contains(text, '|') then 'ValueError: unreadable' end as error from documents""",
    "i2_model_extraction": _with("v_responses v_checked", f"""
select request_id as doc_id, status, {_MODEL_LISTS} from v_checked""", v_checked=_CHECKED),
    "i3_model_explanations": _with("v_entities", """
select distinct category, entity, concat('Category: ', category, chr(10), 'Entity: ', entity)
  as explanation from v_entities where category <> 'Dates'"""),
    "i4_model_letters": _with("v_letters v_texts v_page_numbers", """
select doc_id, page_number, 'whole_text' as letter_status, cast(1 as bigint) as letter_no,
  text as letter from v_texts join v_page_numbers using (doc_id) where doc_id % 4 = 3
union all
select doc_id, page_number, 'parsed', cast(unnest(range(1, len(parts) + 1)) as bigint), unnest(parts)
from (select doc_id, page_number, list_filter(string_split(text, chr(10) || chr(10)), lambda p: trim(p) <> '') as parts
      from v_texts join v_page_numbers using (doc_id) where doc_id % 4 in (0, 2))""", v_texts=_LETTER_TEXTS),
    "j1_incremental_run": _SPLIT_LETTERS,
    "j2_job_tracker": _with("v_poll", f"""
, v_numbered_polls as (
  select *, ts > min(ts) over (partition by job_id) + interval {DEADLINE_SECONDS} second as late,
    row_number() over (partition by job_id order by ts, event_id) as poll_no from v_poll)
select job_id, coalesce(min_by(status, poll_no) filter (not late and status in ('SUCCEEDED', 'FAILED')),
    'TIMED_OUT') as outcome,
  cast(coalesce(min(poll_no) filter (not late and status in ('SUCCEEDED', 'FAILED')),
    count(*) filter (not late)) as bigint) as polls
from v_numbered_polls where poll_no <= {MAX_POLLS} group by job_id"""),
    "k1_edit_distance": _with("v_turns", f"""
select doc_id, distance, {_similarity("raw", "text")} as similarity
from (select *, {_distance("raw", "text")} as distance
      from (select doc_id, replace(text, 'th', 'tb') as raw, text from v_turns))"""),
    "k1_line_distance": _with("v_pairs", f"""
select doc_id, cast(sum(d) as bigint) as distance, count(*) as lines,
  count(*) filter (d > 0) as changed_lines
from (select doc_id, {_distance("a", "b")} as d from (
    select doc_id, unnest(string_split(raw, chr(10))) as a, unnest(string_split(target, chr(10))) as b
    from v_pairs)) group by doc_id"""),
    "k1_document_distance": f"""
select doc_id, cast(length(longer) - length(text) as bigint) as distance,
  {_similarity("longer", "text", "(length(longer) - length(text))")} as similarity
from (select doc_id, text, replace(text, 'th', 'tth') as longer from documents)""",
    "k2_word_count": _with("v_pairs", """
select doc_id, raw_words, corrected_words, corrected_words - raw_words as word_delta
from (select doc_id,
    cast(len(list_filter(string_split(replace(raw, chr(10), ' '), ' '), lambda w: w <> ''))
      as bigint) as raw_words,
    cast(len(list_filter(string_split(replace(coalesce(corrected, raw), chr(10), ' '), ' '),
      lambda w: w <> '')) as bigint) as corrected_words
  from v_pairs)"""),
    "k3_run_consistency": _with("v_turns", f"""
, v_runs as (
  select doc_id, 0 as run, replace(text, 'th', 'tb') as text from v_turns
  union all select doc_id, 1, text from v_turns
  union all select doc_id, 2, replace(text, 'an', 'am') from v_turns),
v_measured as (
  select r.doc_id, r.run, r.text, {_distance("r.text", "f.text")} as d
  from v_runs r join v_runs f on r.doc_id = f.doc_id and f.run = 0),
v_same as (
  select a.doc_id, avg(case when a.text = b.text then 1.0 else 0.0 end) as identical_share
  from v_runs a join v_runs b on a.doc_id = b.doc_id and a.run < b.run group by a.doc_id)
select doc_id, count(*) as n_runs, count(distinct text) as n_variants,
  round(any_value(identical_share), 6) as identical_share, round(avg(d), 6) as avg_distance,
  min(d) filter (run > 0) as min_distance, max(d) as max_distance
from v_measured join v_same using (doc_id) group by doc_id"""),
}
