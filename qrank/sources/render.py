"""SQL (valid in Spark SQL and DuckDB) rendering driver tables as the raw
text formats the readers parse: SGML news files and topic files.

Documents are spread over four collections and files of at most 50
documents (bounded groups), with the cases the parsers must handle:
blanks around DOCNO, missing HEADLINE, <P> and <F ...> tags, multi-line
PJG comments, several documents per file.
"""

DOC_PATH = ("concat(case doc_id % 4 when 0 then 'latimes' when 1 then 'ft' when 2 then 'fr94' else 'fbis' end, "
            "'/sub', cast(cast(floor(doc_id / 200) as bigint) % 3 as string), "
            "'/f', lpad(cast(cast(floor(doc_id / 50) as bigint) as string), 5, '0'))")
NL = "chr(10)"
YEAR = "cast(1900 + doc_id % 100 as string)"
HEAD = f"split_part(text, {NL}, 1)"
REST = f"substr(text, length({HEAD}) + 2)"


def sgml_docs_sql(table: str = "documents") -> str:
    docno = "concat('T', lpad(cast(doc_id as string), 9, '0'))"
    head_ok = "doc_id % 7 <> 0"
    date = (f"case doc_id % 4 "
            f"when 0 then concat('<DATE>', {NL}, '<P>', {NL}, 'January 1, ', {YEAR}, ', Monday', {NL}, '</P>', {NL}, '</DATE>', {NL}) "
            f"when 1 then concat('<DATE>', substr({YEAR}, 3, 2), '0101', '</DATE>', {NL}) "
            f"when 2 then concat('<DATE>', {NL}, '<!-- PJG ITAG l=07 g=1 f=1 -->', {NL}, 'January 1, ', {YEAR}, {NL}, '<!-- PJG /ITAG -->', {NL}, '</DATE>', {NL}) "
            f"else concat('<DATE1> 1 January ', {YEAR}, ' </DATE1>', {NL}) end")
    head = (f"case when not ({head_ok}) then '' "
            f"when doc_id % 4 in (0, 1) then concat('<HEADLINE>', {NL}, '<P>', {NL}, {HEAD}, {NL}, '</P>', {NL}, '</HEADLINE>', {NL}) "
            f"when doc_id % 4 = 2 then concat('<DOCTITLE> ', {HEAD}, ' </DOCTITLE>', {NL}) "
            f"else concat('<TI><H3> ', {HEAD}, ' </H3></TI>', {NL}) end")
    body = (f"case doc_id % 4 "
            f"when 2 then concat(case when doc_id % 3 = 0 then concat('<SUMMARY>', {NL}, {HEAD}, {NL}, '</SUMMARY>', {NL}) else '' end, "
            f"'<TEXT>', {NL}, '<!-- PJG FTAG 4700 -->', {NL}, '<!-- PJG STAG 4700 ', {NL}, 'continued -->', {NL}, {REST}, {NL}, '</TEXT>', {NL}) "
            f"when 3 then concat('<TEXT>', {NL}, '<F P=105> ', {YEAR}, ' </F>', {NL}, {REST}, {NL}, '</TEXT>', {NL}) "
            f"else concat('<TEXT>', {NL}, '<P>', {NL}, {REST}, {NL}, '</P>', {NL}, '</TEXT>', {NL}) end")
    doc = f"concat('<DOC>', {NL}, '<DOCNO> ', {docno}, ' </DOCNO>', {NL}, {date}, {head}, {body}, '</DOC>')"
    return f"select {DOC_PATH} as path, doc_id, {doc} as doc from {table}"


def topic_blocks_sql(table: str = "benchmark") -> str:
    """One topic block per benchmark item (raw text incl. tags)."""
    num = "cast(401 + item_id as string)"
    title = "split_part(text, '.', 1)"
    desc = "split_part(text, '.', 2)"
    narr = "concat(regexp_replace(text, '^[^.]*[.]?[^.]*[.]?', ''), ' Reports on other matters are not relevant. Kept sentence.')"
    date = "case item_id % 3 when 0 then ' Events during the 1990s and 1875 only.' when 1 then ' In the 2010s and 2015, room 1234, 1980S.' else '' end"
    block = (f"concat('<top>', {NL}, {NL}, '<num> Number: ', {num}, ' ', {NL}, '<title> ', {title}, ' ', {NL}, {NL}, "
             f"'<desc> Description: ', {NL}, {desc}, {date}, {NL}, {NL}, '<narr> Narrative: ', {NL}, {narr}, {NL}, {NL}, '</top>')")
    return f"select item_id, cast(floor(item_id / 25) as bigint) as file_id, {block} as block from {table}"
