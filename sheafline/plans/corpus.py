"""Derived inputs: documents, pages, tables and metadata in the shape the operators expect, made from the test tables.

Each is one SELECT that Spark and DuckDB both run, so a query and its SQL read the same rows.
"""

# lines as administrative documents have them: headings, items, leaders, tables, sentences
LINES = """
SELECT o_orderkey AS line_id, CAST(o_orderkey % 97 AS INT) AS doc_id, CASE CAST(o_orderkey % 30 AS INT)
  WHEN 0 THEN concat('Điều ', CAST(o_custkey % 40 AS STRING), '. Phạm vi điều chỉnh')
  WHEN 1 THEN concat('CHƯƠNG ', CAST(o_custkey % 9 + 1 AS STRING), ' NHỮNG QUY ĐỊNH CHUNG')
  WHEN 2 THEN concat('Mục ', CAST(o_custkey % 7 + 1 AS STRING), ' Hồ sơ')
  WHEN 3 THEN concat(CAST(o_custkey % 9 + 1 AS STRING), '. Mục đích:')
  WHEN 4 THEN concat(CAST(o_custkey % 9 + 1 AS STRING), '. Sinh viên nộp hồ sơ tại Phòng CTSV.')
  WHEN 5 THEN concat(CAST(o_custkey % 9 + 1 AS STRING), '.', CAST(o_custkey % 5 + 1 AS STRING), ' Thành phần hồ sơ')
  WHEN 6 THEN 'I. LƯU ĐỒ'
  WHEN 7 THEN 'a. Mục đích: Kết quả điểm rèn luyện được dùng'
  WHEN 8 THEN concat('b) Phạm vi áp dụng ', CAST(o_custkey % 5 AS STRING), ':')
  WHEN 9 THEN 'QUYẾT ĐỊNH'
  WHEN 10 THEN concat(CAST(o_custkey % 90 + 1 AS STRING), '. TÊN MỤC ........ ', CAST(o_custkey % 60 AS STRING))
  WHEN 11 THEN concat('Họ và tên: ............ lớp ', CAST(o_custkey % 60 AS STRING))
  WHEN 12 THEN concat('| ', CAST(o_custkey % 90 AS STRING), ' | ', o_orderpriority, ' |  ', o_orderstatus, '  x |')
  WHEN 13 THEN '|---|:--:|---|'
  WHEN 14 THEN concat('- Theo quy định số ', CAST(o_custkey % 60 AS STRING))
  WHEN 15 THEN 'Quy trình xét điểm rèn luyện'
  WHEN 16 THEN concat('   Sinh viên   khoa ', CAST(o_custkey % 20 AS STRING), '  nộp đơn và ')
  WHEN 17 THEN concat('được xét học bổng lần ', CAST(o_custkey % 4 AS STRING), '.')
  WHEN 18 THEN concat('Email: abc', CAST(o_custkey % 90 AS STRING), ' Qctu.edu.vn')
  WHEN 19 THEN concat('Số: 1L', CAST(o_custkey % 9 AS STRING), '/QĐ-ĐHCT? ngày 5')
  WHEN 20 THEN concat('Điện thoại: 0292 38', CAST(o_custkey % 90 + 10 AS STRING), ' 872 728')
  WHEN 21 THEN concat('2024 Nội dung ', CAST(o_custkey % 60 AS STRING))
  WHEN 22 THEN 'Hồ sơ gồm các giấy tờ sau:'
  WHEN 23 THEN concat('Đơn xin học ', o_orderstatus)
  WHEN 24 THEN concat('Dai hoc Can Tho, khoa ', CAST(o_custkey % 20 AS STRING), '?')
  WHEN 25 THEN concat('TO KHAI THONG TIN ', CAST(o_custkey % 7 AS STRING))
  WHEN 26 THEN concat('i. Quy trình ', CAST(o_custkey % 7 AS STRING))
  WHEN 27 THEN '<!-- note -->'
  WHEN 28 THEN concat('Lần 1 và lần 2: phân loại đơn vị, hồ sơ đạt; ', CAST(floor(o_totalprice) AS INT))
  ELSE concat('Tờ khai họ và tên, ngày sinh, giới tính, CCCD ...... ...... ...... số', CAST(o_custkey AS STRING)) END AS line
FROM orders
"""

# pages with counts of lines found in their images
SIGNALS = """
SELECT l_orderkey AS doc_id, l_linenumber AS page_no, CASE WHEN min(l_returnflag) = 'R' THEN 'Lưu đồ: bước, ghi chú, đơn vị' ELSE 'Văn bản' END AS text,
  CAST(floor(max(l_quantity)) AS INT) AS vector_line_count, CAST(floor(max(l_tax) * 300) AS INT) AS h_count, CAST(floor(max(l_discount) * 80) AS INT) AS v_count
FROM lineitem GROUP BY l_orderkey, l_linenumber
"""

# documents of a few page blocks, one of them twice, after a preamble
PAGED = """
SELECT o_orderkey AS doc_id, concat('preamble', chr(10), '## Trang 1', chr(10), 'one ', o_orderpriority, chr(10), chr(10), '---', chr(10), '<!-- page: 2 -->', chr(10),
  'two ', o_orderstatus, chr(10), '<!-- page: ', CAST(o_custkey % 3 + 2 AS STRING), ' -->', chr(10), 'three ', CAST(o_custkey AS STRING)) AS markdown
FROM orders
"""

# tables of three to five columns in Markdown, some with a row of data as their header
TABLES = """
SELECT o_orderkey AS doc_id, concat(CASE WHEN o_orderkey % 3 = 0 THEN concat('| ', CAST(o_custkey % 30 AS STRING), ' | công nghệ thông tin mới | ', o_orderstatus, ' |') ELSE '| TT | Ngành | Mức |' END, chr(10),
  '| --- | --- | --- |', chr(10), '| 1 | ', o_orderpriority, ' | b | c |', chr(10), '|2|x|', CASE WHEN o_orderkey % 2 = 0 THEN 'y|z|w|' ELSE '' END, chr(10), chr(10), 'after') AS markdown
FROM orders
"""

# metadata of documents, some of it missing or wrong
METADATA = """
SELECT o_orderkey AS doc_id, concat('---', chr(10), 'document_id: doc-', CAST(o_orderkey AS STRING), chr(10), 'title: "Order ', CAST(o_custkey AS STRING), '"', chr(10),
  'is_latest: ', CASE WHEN o_orderkey % 4 = 0 THEN 'yes' ELSE 'true' END, chr(10), 'audience:', CASE WHEN o_orderkey % 5 = 0 THEN ' student' ELSE concat(chr(10), '  - student', chr(10), '  - staff') END, chr(10),
  'rag_status: ', CASE WHEN o_orderstatus = 'F' THEN 'published' WHEN o_orderstatus = 'O' THEN 'indexed' ELSE 'unknown' END, chr(10), 'ocr_status: done', chr(10),
  'review_status: ', CASE WHEN o_orderkey % 7 = 0 THEN 'approved' ELSE '' END, chr(10), 'issued_date: ', CASE WHEN o_orderkey % 6 = 0 THEN '2024-1-5' ELSE '2024-01-05' END, chr(10),
  'color: red', chr(10), '---', chr(10), chr(10), 'body ', CAST(o_orderkey AS STRING)) AS text
FROM orders
"""

# source files and the documents made of them
FILES = "SELECT concat('/data/PDFs/', p_brand, '/', p_name, ' ', CAST(p_partkey AS STRING), '.pdf') AS path, p_partkey FROM part"
MADE = "SELECT p_partkey AS doc_id, concat('/out/', p_name, '_', CAST(p_partkey AS STRING), '_structured.md') AS md_path FROM part"

# boxes of four points, pages of up to seven boxes
BOXES = """
SELECT CAST(l_orderkey AS STRING) AS page_key, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS INT) AS box_no,
  l_quantity * 3.5 AS x1, floor(l_extendedprice / 1000) * 4.5 AS y1, l_quantity * 3.5 + 40 AS x2, floor(l_extendedprice / 1000) * 4.5 + 12 + l_tax * 50 AS y2 FROM lineitem
"""
