"""Raw catalog cells derived from the given tables.

The catalogs themselves are not at hand, so the recipes run on text made from
clean columns: dates at several precisions, doubted and suffixed numbers, padded
values, null marks, list cells and values that the corrections know. The checks
compute the expected tables from the clean columns and never parse this text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledger_queries.registry import Tables
from skyledger.sources.registry import LAYOUTS, OBJECT_CATALOGS, PAYLOAD_CATALOGS


def day(c: str) -> str:
    """SQL for a date as ``2016 Jun  8``."""
    return f"concat(date_format({c}, 'yyyy MMM '), lpad(day({c}), 2, ' '))"


def quarter(c: str) -> str:
    return f"concat(year({c}), ' Q', quarter({c}))"


def layout(df: DataFrame, name: str, first: dict[str, str] | None = None, **cells: str) -> DataFrame:
    """All columns of a layout, after those in `first`; cells not given hold the null mark."""
    unknown = set(cells) - set(LAYOUTS[name].split())
    if unknown:
        raise ValueError(f"{name} has no columns {unknown}")
    texts = (first or {}) | {c: cells.get(c, "'-'") for c in LAYOUTS[name].split()}
    return df.selectExpr(*[f"{text} AS `{c}`" for c, text in texts.items()])


# A day derived from a key; both sides of the check use the same rule.
KEY_DAY = "CAST(DATE'1990-01-01' + make_interval(0, 0, 0, CAST({key} % 9999 AS INT)) AS TIMESTAMP_NTZ)"


def catalog(first: str, main: str, rest: str, catalogs: list[str]) -> str:
    """SQL, for both sides, of the catalog a row stands in: the main one, or one of the others by a number."""
    others = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(catalogs) if name != main)
    return f"CASE WHEN {first} THEN '{main}' ELSE CASE CAST({rest} % {len(catalogs)} AS INTEGER) {others} ELSE '{main}' END END"


OBJECT_CATALOG = catalog("l_returnflag = 'A'", "satcat", "l_partkey", list(OBJECT_CATALOGS))
PAYLOAD_CATALOG = catalog("event_type = 'view'", "psatcat", "event_id", list(PAYLOAD_CATALOGS))


def orgs(t: Tables) -> DataFrame:
    start = KEY_DAY.format(key="c_custkey")
    return layout(
        t.customer,
        "orgs",
        Code="concat('C', c_custkey)",
        UCode="concat('  ', c_name, ' ')",
        StateCode="concat('N', c_nationkey)",
        Type="CASE c_mktsegment WHEN 'BUILDING' THEN 'LV//PL' WHEN 'MACHINERY' THEN 'E' WHEN 'HOUSEHOLD' THEN '-' ELSE 'LA/O/' END",
        Class="CASE WHEN c_mktsegment = 'FURNITURE' THEN '-' ELSE concat(c_mktsegment, ' ') END",
        TStart=day(start),
        TStop=f"CASE c_mktsegment WHEN 'BUILDING' THEN concat(year({start}), '?') WHEN 'MACHINERY' THEN '*' ELSE {quarter(start)} END",
        ShortName="c_name",
        Longitude="CAST(c_acctbal AS STRING)",
        Latitude="concat(CAST(c_acctbal AS STRING), '?')",
        Error="concat(c_nationkey, 'M')",
        Parent="CASE c_mktsegment WHEN 'BUILDING' THEN '-' WHEN 'MACHINERY' THEN 'MOTI/TMI' ELSE concat('C', c_nationkey) END",
    )


def sites(t: Tables) -> DataFrame:
    start = KEY_DAY.format(key="s_suppkey")
    return layout(
        t.supplier,
        "sites",
        Site="concat('S', s_suppkey)",
        UCode="concat(s_name, '  ')",
        Type="'LS'",
        StateCode="concat('N', s_nationkey)",
        TStart=f"CASE WHEN s_acctbal < 0 THEN '1974 Nov  6:' ELSE {day(start)} END",
        TStop=f"concat(substr(CAST(year({start}) AS STRING), 1, 3), '0s')",
        Name="s_name",
        Longitude="CAST(s_acctbal AS STRING)",
        Parent="CASE WHEN s_acctbal < 0 THEN '-' ELSE concat('C', s_nationkey, '/', 'C', s_suppkey + 50, '?') END",
        Group="concat(s_nationkey, ' ')",
    )


def platforms(t: Tables) -> DataFrame:
    start = KEY_DAY.format(key="s_suppkey")
    return layout(
        t.supplier,
        "platforms",
        Code="concat('P', s_suppkey)",
        Type="'SHIP'",
        TStart=f"date_format({start}, 'yyyy MMM')",
        Latitude="concat(CAST(s_acctbal AS STRING), '?')",
        Parent="concat('C', s_nationkey, '?')",
        VClass="s_name",
        VClassID="concat(' ', s_suppkey)",
    )


def lp(t: Tables) -> DataFrame:
    start = KEY_DAY.format(key="p_partkey")
    return layout(
        t.part,
        "lp",
        Site="concat('S', p_size)",
        Code="concat('L', p_partkey)",
        Type="p_type",
        TStart=f"concat({day(start)}, ' 23h')",
        TStop="CASE WHEN p_type = 'PROMO' THEN 'DZK3  -' ELSE '21C?' END",
        Name="p_name",
        Error="CAST(p_retailprice AS STRING)",
        Parent="CASE p_type WHEN 'PROMO' THEN 'PRC/DNVG?' WHEN 'SMALL' THEN '-' ELSE concat('C', p_size, '/PRCX') END",
    )


def family(t: Tables) -> DataFrame:
    return layout(t.part, "family", Family="CASE WHEN p_type = 'SMALL' THEN '-' ELSE p_brand END")


def lv(t: Tables) -> DataFrame:
    return layout(
        t.part,
        "lv",
        LV_Name="concat('V', p_partkey)",
        LV_Family="p_brand",
        LV_Manufacturer="CASE p_type WHEN 'SMALL' THEN '-' WHEN 'PROMO' THEN 'ROKTSN/TIAB?' WHEN 'LARGE' THEN 'NCSIST' ELSE concat('C', p_size) END",
        LV_Variant="CASE WHEN p_type IN ('SMALL', 'PROMO') THEN '-' ELSE concat(p_type, ' ') END",
        LV_Min_Stage="CAST(p_size AS STRING)",
        Launch_Mass="concat(p_retailprice, '?')",
        LEO_Capacity="CASE WHEN p_type = 'SMALL' THEN '?' ELSE concat(p_size, 'M?') END",
        Apogee="concat(p_size, 'yr')",
    )


def refs(t: Tables) -> DataFrame:
    return layout(t.documents, "refs", Cite="concat('D', doc_id)", Reference="concat('  ', text, ' ')")


def launch(t: Tables) -> DataFrame:
    return layout(
        t.orders,
        "launch",
        Launch_Tag="concat('T', o_orderkey)",
        Launch_JD="CAST(o_totalprice AS STRING)",
        Launch_Date=f"""CASE o_orderpriority WHEN '1-URGENT' THEN concat({day("o_orderdate")}, ' 0630?')
          WHEN '2-HIGH' THEN date_format(o_orderdate, 'yyyy MMM') WHEN '3-MEDIUM' THEN concat(year(o_orderdate), '?')
          WHEN '4-NOT SPECIFIED' THEN {quarter("o_orderdate")} ELSE concat({day("o_orderdate")}, '.25') END""",
        LV_Type="CASE o_orderstatus WHEN 'O' THEN 'Ghadr-110' ELSE concat('V', o_custkey) END",
        Variant="CASE o_orderstatus WHEN 'P' THEN '-' ELSE 'B?' END",
        Flight_ID="o_orderpriority",
        Mission="concat(' ', o_orderstatus)",
        Platform="CASE o_orderstatus WHEN 'F' THEN 'SS-088?' WHEN 'O' THEN concat('P', o_custkey, '?') ELSE '-' END",
        Launch_Site="CASE o_orderstatus WHEN 'O' THEN 'NIIP-5?' WHEN 'F' THEN 'CC' ELSE concat('S', o_custkey, '?') END",
        Launch_Pad="""CASE o_orderpriority WHEN '1-URGENT' THEN 'LC46' WHEN '2-HIGH' THEN 'LC603  ' WHEN '3-MEDIUM' THEN 'LC81?'
          ELSE 'L1?' END""",
        Ascent_Site="CASE o_orderstatus WHEN 'O' THEN 'DGAEML?' WHEN 'F' THEN 'KMR' ELSE '-' END",
        Ascent_Pad="CASE o_orderstatus WHEN 'F' THEN 'Lp1' ELSE 'X?' END",
        Apogee="concat(o_custkey, '?')",
        Range="'2M'",
        Dest="o_orderstatus",
        Agency="CASE o_orderpriority WHEN '5-LOW' THEN '-' ELSE concat('C', o_custkey, '/NASA?//') END",
        LaunchCode="CASE o_orderstatus WHEN 'O' THEN 'OS' WHEN 'F' THEN 'AF75' ELSE 'DU' END",
        Group="CASE o_orderstatus WHEN 'O' THEN 'C/X/D' WHEN 'F' THEN concat('C', o_custkey, '?/Lab/Smith', o_custkey, ',Jones?') ELSE 'G' END",
        Category="o_orderpriority",
        LTCite="concat('D', o_custkey)",
    )


def worlds(t: Tables) -> DataFrame:
    start = KEY_DAY.format(key="s_suppkey")
    return layout(
        t.supplier,
        "worlds",
        IDT="'W'",
        IDName="concat('(', s_suppkey, ')')",
        Name="s_name",
        Radius="concat(CAST(s_acctbal AS STRING), '?')",
        Mass="concat(s_suppkey, 'E24')",
        OrbPeriod="concat(s_nationkey, 'yr')",
        RotPeriod="CAST(s_nationkey AS STRING)",
        Epoch=f"concat({day(start)}, '  0630:15')",
        WType="CASE WHEN s_acctbal < 0 THEN '-' ELSE 'Ast' END",
        Primary="CASE WHEN s_acctbal < 0 THEN '-' WHEN s_nationkey < 5 THEN 'EMB' WHEN s_nationkey < 10 THEN 'Sol' ELSE concat('Supplier#', lpad(s_nationkey, 9, '0')) END",
    )


def spin(t: Tables) -> DataFrame:
    return layout(
        t.supplier.filter("s_acctbal < 0"),
        "spin",
        IDName="concat('(', s_suppkey, ')')",
        Rho="CAST(s_nationkey AS STRING)",
        J2="concat(s_nationkey, 'E-3?')",
        PoleFunc="concat('f', s_nationkey)",
    )


def objects(t: Tables) -> DataFrame:
    return layout(
        t.lineitem,
        "object",
        {"s_catalog": OBJECT_CATALOG},
        JCAT="concat('J', l_orderkey, '-', l_linenumber)",
        Satcat="concat(' ', l_partkey, ' ')",
        Launch_Tag="""CASE WHEN l_linenumber = 7 THEN '-          UNK' WHEN l_linestatus = 'O' THEN concat('T', l_orderkey, '  199')
          ELSE concat('T', l_orderkey) END""",
        Piece="concat(year(l_shipdate), ' ', l_linenumber)",
        Type="concat(l_returnflag, ' -', l_linestatus, 'X')",
        Name="concat('Item ', l_partkey)",
        LDate=day("l_shipdate"),
        Parent="CASE l_linenumber WHEN 1 THEN 'SEL1' WHEN 2 THEN 'Earth*' ELSE concat('J', l_orderkey, '-1  port', l_linenumber) END",
        SDate=f"""concat({day("l_shipdate")}, ' 0', l_linenumber, lpad(CAST(l_quantity AS INT), 2, '0'),
          CASE l_linestatus WHEN 'F' THEN '?' ELSE '' END)""",
        Primary="'Earth'",
        DDate="CASE WHEN month(l_shipdate) = 3 THEN concat(year(l_shipdate), ' Mar  0') ELSE CAST(year(l_shipdate) AS STRING) END",
        Status="l_linestatus",
        Owner="CASE l_linenumber WHEN 1 THEN '-' WHEN 2 THEN 'NROC/NROC' ELSE concat('C', l_suppkey, '/N', l_linenumber, '?') END",
        State="CASE l_linenumber WHEN 1 THEN '-' ELSE concat('C', l_suppkey) END",
        Manufacturer="CASE l_linestatus WHEN 'F' THEN '-' ELSE concat('C', l_suppkey, '?/M', l_linenumber, '??') END",
        Mass="CAST(l_quantity AS STRING)",
        MassFlag="l_returnflag",
        DryMass="concat(CAST(l_discount AS STRING), '?')",
        TotMass="concat(l_linenumber, 'M')",
        Length="CAST(l_tax AS STRING)",
        ODate=quarter("l_shipdate"),
        Perigee="CAST(l_extendedprice AS STRING)",
        Apogee="CASE WHEN l_discount = 0 THEN 'Inf' ELSE concat(CAST(l_extendedprice AS STRING), '?') END",
        Inc="CAST(l_linenumber AS STRING)",
        OpOrbit="concat(l_returnflag, l_linestatus)",
    )


def usatcat(t: Tables) -> DataFrame:
    return layout(t.orders, "usatcat", JCAT="concat('J', o_orderkey, '-1')", Name="concat(' ', o_orderpriority)")


def payloads(t: Tables) -> DataFrame:
    return layout(
        t.events,
        "payload",
        {"pay_catalog": PAYLOAD_CATALOG},
        JCAT="concat('E', event_id)",
        Piece="concat(' ', user_id)",
        Name="event_type",
        LDate="CASE event_type WHEN 'error' THEN '22 Feb 27' ELSE " + day("ts") + " END",
        TLast="'*'",
        TOp=f"concat({day('ts')}, date_format(ts, ' HHmm:ss'), '?')",
        TDate="CASE event_type WHEN 'view' THEN '* E' ELSE date_format(ts, 'yyyy MMM') END",
        Mvr="CASE event_type WHEN 'click' THEN 'm' ELSE 'N' END",
        Class="concat(event_type, ' ')",
        Category="CASE event_type WHEN 'view' THEN '-' WHEN 'click' THEN concat('COM*/U', user_id, '?') ELSE concat('SCI?/', event_type, '*?') END",
        Discipline="CASE event_type WHEN 'view' THEN 'AS*/EO?' ELSE '-' END",
        UNState="CASE event_type WHEN 'view' THEN '-' WHEN 'click' THEN concat('[C', user_id, ']*') ELSE concat('C', user_id) END",
        UNPeriod="concat(CAST(value AS STRING), '?')",
        DispEpoch=f"concat({day('ts')}, '.5')",
        DispInc="CAST(user_id AS STRING)",
    )


def engines(t: Tables) -> DataFrame:
    return layout(
        t.part,
        "engines",
        {"line_number": "p_partkey + 1"},
        Name="p_name",
        Manufacturer="CASE p_type WHEN 'SMALL' THEN '-' WHEN 'PROMO' THEN 'Zulfiqar/SNC?' ELSE concat('C', p_size, '/IRAN') END",
        Family="concat(p_brand, ' ')",
        Oxidizer="CASE p_type WHEN 'SMALL' THEN '-' ELSE 'LOX?/RFNA AK-20' END",
        Fuel="CASE p_type WHEN 'PROMO' THEN 'JPX (JP-4/UDMH)' WHEN 'SMALL' THEN 'MMH/' ELSE concat('AlTP-H-3062/F', p_size) END",
        Mass="concat(CAST(p_retailprice AS STRING), '?')",
        Thrust="concat(p_size, 'M')",
        Date="CASE p_type WHEN 'SMALL' THEN '-' ELSE date_format(" + KEY_DAY.format(key="p_partkey") + ", 'yyyy MMM') END",
        Usage="p_type",
    )


def stages(t: Tables) -> DataFrame:
    return layout(
        t.part,
        "stages",
        Stage_Name="CASE p_type WHEN 'SMALL' THEN '?' ELSE concat('G', p_partkey) END",
        Stage_Family="p_brand",
        Stage_Manufacturer="CASE p_type WHEN 'PROMO' THEN 'SALT/ARMT   -' WHEN 'LARGE' THEN 'NCSIST/C1?' WHEN 'MEDIUM' THEN '-' ELSE concat('C', p_size) END",
        Length="CAST(p_size AS STRING)",
        Launch_Mass="concat(p_retailprice, '?')",
        Engine="CASE p_type WHEN 'PROMO' THEN '-' ELSE p_name END",
        NEng="CAST(p_size AS STRING)",
    )


def lvs(t: Tables) -> DataFrame:
    return layout(
        t.lineitem,
        "lvs",
        LV_Name="concat('V', l_partkey)",
        LV_Variant="CASE l_linestatus WHEN 'F' THEN '-' ELSE l_returnflag END",
        Stage_No="CAST(l_linenumber AS STRING)",
        Stage_Name="CASE l_returnflag WHEN 'A' THEN 'Fairing' ELSE concat('G', l_partkey) END",
        Multiplicity="CAST(l_quantity AS STRING)",
        Stage_Impulse="concat(CAST(l_extendedprice AS STRING), '?')",
        Stage_Perigee="concat(l_linenumber, 'M')",
    )
