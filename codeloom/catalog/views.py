"""Survey-shaped views over the given tables, in SQL that both engines read unchanged.

``{name}`` fields stand for tables or other views. Every view reads its tables whole.
"""

VIEWS = {
    # One response per order: dirty titles, employers, coded answers and partly missing target codes. Orders without lines have no
    # titles, employer and codes of their own.
    "survey": """
        select cast(o.o_orderkey as bigint) as id,
          case when p.p_name is null then null else case o.o_orderkey % 6
            when 0 then concat(upper(p.p_name), ' Mgr.')
            when 1 then concat('  ', p.p_name, ',  Asst ')
            when 2 then concat(p.p_name, ' Tech')
            when 3 then (case when o.o_orderkey % 4 = 3 then null else p.p_name end)
            when 4 then concat(split_part(p.p_name, ' ', 2), ' ', split_part(p.p_name, ' ', 1))
            else p.p_name end end as qe4,
          case when q.p_name is null then null else case o.o_orderkey % 5
            when 0 then null
            when 1 then concat(q.p_name, ' Svc')
            when 2 then concat('Sr. ', q.p_name)
            else q.p_name end end as qe5a,
          s.s_name as qa20,
          case when o.o_orderkey % 7 = 0 or p.p_type is null then null else concat('Industry & ', p.p_type) end as qe1oth,
          case when o.o_orderkey % 13 = 0 and c.c_mktsegment is not null then concat(c.c_mktsegment, ' svcs') else null end as qe8aoth,
          case when o.o_orderkey % 3 = 0 or c.c_nationkey is null then null else concat('City ', cast(c.c_nationkey as varchar(10))) end as qe2b,
          o.o_orderstatus as qe1,
          p.p_brand as qse1,
          o.o_orderpriority as qa9,
          case when o.o_orderkey % 11 = 0 then null else cast(p.p_size as double) end as qe10,
          case when o.o_orderkey % 9 = 0 then null
               when o.o_orderkey % 10 = 1 then cast(999999 as double)
               when o.o_orderkey % 25 = 2 then cast(110000 + o.o_custkey % 40 as double)
               else cast(311000 + s.s_suppkey % 10 as double) end as qa20a,
          case when o.o_orderkey % 8 = 0 then null
               when o.o_orderkey % 30 = 3 then cast(990000 + p.p_partkey % 9 as double)
               when o.o_orderkey % 30 = 7 then cast(431000 + p.p_partkey % 50 as double)
               else cast((11 + 2 * (ascii(p.p_name) % 23)) * 10000 + 1000 + 10 * length(p.p_name) as double) end as qe4ar,
          case when o.o_orderkey % 4 = 1 then null
               when o.o_orderkey % 28 = 3 then cast(431000 + q.p_partkey % 50 as double)
               else cast((11 + 2 * (ascii(q.p_name) % 23)) * 10000 + 1000 + 10 * length(q.p_name) as double) end as qe5ar
        from {orders} o
        left join (select l_orderkey, min(l_partkey) as part_no, max(l_partkey) as other_part_no, min(l_suppkey) as supplier_no
              from {lineitem} group by l_orderkey) l on l.l_orderkey = o.o_orderkey
        left join {part} p on p.p_partkey = l.part_no
        left join {part} q on q.p_partkey = l.other_part_no
        left join {supplier} s on s.s_suppkey = l.supplier_no
        left join {customer} c on c.c_custkey = o.o_custkey
    """,
    # Codes as they arrive from files: padded, blank, with decimals, with suffixes, or numeric.
    "raw_codes": """
        select cast(o_orderkey as bigint) as id,
          case o_orderkey % 9
            when 0 then concat('00', cast(o_custkey as varchar(20)), '.0')
            when 1 then concat('  ', cast(o_custkey as varchar(20)), '.00 ')
            when 2 then ''
            when 3 then '   '
            when 4 then concat(cast(o_custkey as varchar(20)), 'd')
            when 5 then concat(cast(o_custkey as varchar(20)), 'e2')
            when 6 then null
            when 7 then concat('A-', cast(o_custkey as varchar(20)))
            else concat(' ', cast(o_custkey % 3 * 999 as varchar(20))) end as code_text,
          case o_orderkey % 6
            when 0 then o_totalprice
            when 1 then cast(110000 + o_custkey as double)
            when 2 then cast(99999.7 as double)
            when 3 then null
            when 4 then cast(o_custkey % 3 * 999 as double)
            else cast(o_custkey % 60 * 10000 + o_custkey % 10000 as double) + 0.5 end as code_number
        from {orders}
    """,
    # Class probabilities of three models, from the weight of each order's lines.
    "line_weights": """
        select cast(l_orderkey as bigint) as id, code, sum(l_quantity) as w1, sum(l_extendedprice) as w2, count(*) as w3
        from (select l_orderkey, l_quantity, l_extendedprice, cast(311000 + l_suppkey % 8 as varchar(6)) as code from {lineitem}) t
        group by l_orderkey, code
    """,
    "proba": "select id, code, w1 / sum(w1) over (partition by id) as prob from {line_weights}",
    "proba_b": "select id, code, w2 / sum(w2) over (partition by id) as prob from {line_weights}",
    "proba_c": "select id, code, cast(w3 as double) / sum(w3) over (partition by id) as prob from {line_weights}",
    "truth": "select cast(o_orderkey as bigint) as id, cast(311000 + o_custkey % 8 as varchar(6)) as label from {orders}",
    # Two-level probabilities: major groups, and codes inside each.
    "two_level": """
        select id, major, code, sum(q) as q, sum(x) as x
        from (select cast(l_orderkey as bigint) as id, cast(11 + 2 * (l_partkey % 23) as int) as major,
                     cast((11 + 2 * (l_partkey % 23)) * 10000 + 1000 + 10 * (l_suppkey % 5) as varchar(6)) as code,
                     l_quantity as q, l_extendedprice as x from {lineitem}) t
        group by id, major, code
    """,
    "majors": """
        select id, major, sum(q) / sum(sum(q)) over (partition by id) as p_major from {two_level} group by id, major
    """,
    "within": "select id, major, code, x / sum(x) over (partition by id, major) as p_within from {two_level}",
    "codebook": """
        select case when n.n_nationkey = 0 then '999999' else cast(111000 + 10 * n.n_nationkey as varchar(6)) end as soc_code,
               n.n_name as title, concat(r.r_name, ' & Co.') as description
        from {nation} n join {region} r on n.n_regionkey = r.r_regionkey
    """,
    # Raw answers of an external chooser.
    "answers": """
        select cast(o_orderkey as bigint) as id,
          case o_orderkey % 4
            when 0 then concat('{{"code":"', cast(311000 + o_orderkey % 8 as varchar(6)), '"}}')
            when 1 then concat('I pick ', cast(311000 + o_orderkey % 8 as varchar(6)), '.')
            when 2 then 'no idea'
            else '{{"code":"999111"}}' end as answer
        from {orders}
    """,
    "memory": """
        select cast(vec_id as bigint) as ex_id, cast(311000 + label as varchar(6)) as label,
               case when vec_id % 10 = 1 then cast(0.6 as double) else cast(1.0 as double) end as weight, embedding as vec
        from {embeddings}
    """,
}
