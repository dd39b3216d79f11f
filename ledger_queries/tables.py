"""The thirty table recipes on derived cells, checked from the clean columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger_queries import cells
from ledger_queries.registry import Tables, query
from skyledger.plans import tables as recipes
from skyledger.plans.shape import Inputs


def nulls(names: str, kind: str = "VARCHAR") -> str:
    return ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name in names.split())


#: Rows of the main object catalog.
MAIN_CATALOG = f"{cells.OBJECT_CATALOG} = 'satcat'"


def key_day(table: str, key: str) -> str:
    return f"(SELECT *, TIMESTAMP '1990-01-01' + to_days(CAST({key} % 9999 AS INTEGER)) AS d FROM {table})"


@query(
    "table_organization_type",
    """
    WITH uses AS (
      SELECT unnest(CASE c_mktsegment WHEN 'BUILDING' THEN ['LV', 'PL'] WHEN 'MACHINERY' THEN ['E'] WHEN 'HOUSEHOLD' THEN []
        ELSE ['LA', 'O'] END) AS ot_type FROM customer),
    types AS (
      SELECT unnest(['CY', 'CYP', 'IGO', 'AP']) AS ot_type, 'States and similar entities' AS ot_group
      UNION ALL SELECT unnest(['E', 'LV', 'W', 'PL']), 'Manufacturers'
      UNION ALL SELECT unnest(['LA', 'S', 'O', 'P']), 'Operators'
      UNION ALL SELECT unnest(['LS', 'LP', 'LC', 'LZ', 'TGT']), 'Launch origin or destination')
    SELECT t.ot_group, t.ot_type, count(u.ot_type) AS organizations
    FROM types t LEFT JOIN uses u ON t.ot_type = u.ot_type GROUP BY ALL""",
)
def organization_type(t: Tables) -> DataFrame:
    """How many organizations use each type; unused types show zero."""
    types = recipes.organization_type(t.spark)
    links = recipes.organization_org_type(Inputs({"orgs": cells.orgs(t)}))
    uses = links.groupBy("oot_ot_type").agg(F.count("*").alias("n"))
    joined = types.join(uses, types.ot_type == uses.oot_ot_type, "left")
    return joined.select("ot_group", "ot_type", F.coalesce("n", F.lit(0)).alias("organizations"))


@query(
    "table_organization",
    f"""
    SELECT 'C' || c_custkey AS o_code, c_name AS o_ucode, 'N' || c_nationkey AS o_statecode,
      CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_mktsegment END AS o_class,
      d AS o_tstart, 'Day' AS o_tstart_precision,
      CASE c_mktsegment WHEN 'BUILDING' THEN date_trunc('year', d) WHEN 'MACHINERY' THEN NULL ELSE date_trunc('quarter', d) END AS o_tstop,
      CASE c_mktsegment WHEN 'BUILDING' THEN 'Years' WHEN 'MACHINERY' THEN NULL ELSE 'Quarter' END AS o_tstop_precision,
      c_name AS o_shortname, c_acctbal AS o_longitude, c_acctbal AS o_latitude, CAST(c_nationkey * 1000000 AS DOUBLE) AS o_error,
      CASE c_mktsegment WHEN 'BUILDING' THEN NULL WHEN 'MACHINERY' THEN 'MOTI' ELSE 'C' || c_nationkey END AS o_parent_o_code,
      {nulls("o_name o_location o_shortename o_ename o_uname")}
    FROM {key_day("customer", "c_custkey")}""",
)
def organization(t: Tables) -> DataFrame:
    return recipes.organization(Inputs({"orgs": cells.orgs(t)}))


@query(
    "table_organization_org_type",
    """
    SELECT 'C' || c_custkey AS oot_o_code, unnest(CASE c_mktsegment WHEN 'BUILDING' THEN ['LV', 'PL'] WHEN 'MACHINERY' THEN ['E']
      WHEN 'HOUSEHOLD' THEN [] ELSE ['LA', 'O'] END) AS oot_ot_type FROM customer""",
)
def organization_org_type(t: Tables) -> DataFrame:
    return recipes.organization_org_type(Inputs({"orgs": cells.orgs(t)}))


@query(
    "table_site",
    f"""
    SELECT 'S' || s_suppkey AS site_code, s_name AS site_ucode, 'LS' AS site_type, 'N' || s_nationkey AS site_statecode,
      CASE WHEN s_acctbal < 0 THEN TIMESTAMP '1974-11-06' ELSE d END AS site_tstart, 'Day' AS site_tstart_precision,
      date_trunc('decade', d) AS site_tstop, 'Decade' AS site_tstop_precision, s_name AS site_name,
      s_acctbal AS site_longitude, CAST(s_nationkey AS VARCHAR) AS site_group,
      {nulls("site_latitude site_error", "DOUBLE")},
      {nulls("site_shortname site_location site_shortename site_ename site_uname")}
    FROM {key_day("supplier", "s_suppkey")}""",
)
def site(t: Tables) -> DataFrame:
    return recipes.site(Inputs({"sites": cells.sites(t)}))


@query(
    "table_site_org",
    """
    SELECT 'S' || s_suppkey AS so_site_code, unnest(['C' || s_nationkey, 'C' || (s_suppkey + 50)]) AS so_o_code
    FROM supplier WHERE s_acctbal >= 0""",
)
def site_org(t: Tables) -> DataFrame:
    return recipes.site_org(Inputs({"sites": cells.sites(t)}))


@query(
    "table_platform",
    f"""
    SELECT 'P' || s_suppkey AS p_code, 'SHIP' AS p_type, date_trunc('month', d) AS p_tstart, 'Month' AS p_tstart_precision,
      s_acctbal AS p_latitude, s_name AS p_vclass, CAST(s_suppkey AS VARCHAR) AS p_vclassid,
      {nulls("p_tstop", "TIMESTAMP")}, {nulls("p_longitude p_error", "DOUBLE")},
      {nulls("p_ucode p_statecode p_class p_tstop_precision p_shortname p_name p_location p_shortename p_ename p_vid p_group p_uname")}
    FROM {key_day("supplier", "s_suppkey")}""",
)
def platform(t: Tables) -> DataFrame:
    return recipes.platform(Inputs({"platforms": cells.platforms(t)}))


@query("table_platform_org", "SELECT 'P' || s_suppkey AS po_p_code, 'C' || s_nationkey AS po_o_code FROM supplier")
def platform_org(t: Tables) -> DataFrame:
    return recipes.platform_org(Inputs({"platforms": cells.platforms(t)}))


@query(
    "table_launch_point",
    f"""
    SELECT 'S' || p_size AS lp_site_code, 'L' || p_partkey AS lp_code, p_type AS lp_type,
      d + INTERVAL 23 HOUR AS lp_tstart, 'Hour' AS lp_tstart_precision,
      CASE WHEN p_type = 'PROMO' THEN NULL ELSE TIMESTAMP '2000-01-01' END AS lp_tstop,
      CASE WHEN p_type = 'PROMO' THEN NULL ELSE 'Centuries' END AS lp_tstop_precision,
      p_name AS lp_name, p_retailprice AS lp_error, {nulls("lp_longitude lp_latitude", "DOUBLE")},
      {nulls("lp_ucode lp_statecode lp_shortname lp_location lp_shortename lp_ename lp_uname")}
    FROM {key_day("part", "p_partkey")}""",
)
def launch_point(t: Tables) -> DataFrame:
    return recipes.launch_point(Inputs({"lp": cells.lp(t)}))


@query(
    "table_launch_point_org",
    """
    SELECT 'S' || p_size AS lpo_site_code, 'L' || p_partkey AS lpo_lp_code,
      unnest(CASE p_type WHEN 'PROMO' THEN ['CN', 'DVNG'] WHEN 'SMALL' THEN [] ELSE ['C' || p_size, 'PRCX'] END) AS lpo_o_code
    FROM part""",
)
def launch_point_org(t: Tables) -> DataFrame:
    return recipes.launch_point_org(Inputs({"lp": cells.lp(t)}))


@query(
    "table_launch_vehicle_family",
    """
    SELECT DISTINCT p_brand AS lvf_family FROM part WHERE p_type <> 'SMALL'
    UNION SELECT 'Spectrum' UNION SELECT 'PrSM'""",
)
def launch_vehicle_family(t: Tables) -> DataFrame:
    return recipes.launch_vehicle_family(Inputs({"family": cells.family(t)}))


@query(
    "table_launch_vehicle",
    f"""
    SELECT 'V' || p_partkey AS lv_name, p_brand AS lv_lvf_family,
      CASE WHEN p_type IN ('SMALL', 'PROMO') THEN NULL ELSE p_type END AS lv_variant,
      CAST(p_size AS DOUBLE) AS lv_min_stage, p_retailprice AS lv_launch_mass,
      CASE WHEN p_type = 'SMALL' THEN NULL ELSE CAST(p_size * 1000000 AS DOUBLE) END AS lv_leo_capacity,
      CAST(CAST(p_size AS DECIMAL(9, 0)) * 365.26 AS DOUBLE) AS lv_apogee,
      {nulls("lv_max_stage lv_length lv_diameter lv_gto_capacity lv_to_thrust lv_range", "DOUBLE")},
      {nulls("lv_alias lv_lflag lv_dflag lv_mflag lv_class")}
    FROM part""",
)
def launch_vehicle(t: Tables) -> DataFrame:
    return recipes.launch_vehicle(Inputs({"lv": cells.lv(t)}))


@query(
    "table_launch_vehicle_org",
    """
    SELECT 'V' || p_partkey AS lvo_lv_name, CASE WHEN p_type = 'PROMO' THEN NULL ELSE p_type END AS lvo_lv_variant,
      unnest(CASE p_type WHEN 'PROMO' THEN ['ROKSN', 'TIANB'] WHEN 'LARGE' THEN [NULL] ELSE ['C' || p_size] END) AS lvo_o_code
    FROM part WHERE p_type <> 'SMALL'""",
)
def launch_vehicle_org(t: Tables) -> DataFrame:
    return recipes.launch_vehicle_org(Inputs({"lv": cells.lv(t)}))


@query("table_reference", "SELECT 'D' || doc_id AS r_cite, trim(text, ' ') AS r_reference FROM documents")
def reference(t: Tables) -> DataFrame:
    return recipes.reference(Inputs({"refs": cells.refs(t)}))


@query(
    "table_launch",
    f"""
    SELECT 'T' || o_orderkey AS l_launch_tag, o_totalprice AS l_launch_jd,
      CASE o_orderpriority WHEN '1-URGENT' THEN o_orderdate + INTERVAL 390 MINUTE WHEN '2-HIGH' THEN date_trunc('month', o_orderdate)
        WHEN '3-MEDIUM' THEN date_trunc('year', o_orderdate) WHEN '4-NOT SPECIFIED' THEN date_trunc('quarter', o_orderdate)
        ELSE o_orderdate + INTERVAL 6 HOUR END AS l_launch_date,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'Minutes' WHEN '2-HIGH' THEN 'Month' WHEN '3-MEDIUM' THEN 'Years'
        WHEN '4-NOT SPECIFIED' THEN 'Quarter' ELSE 'Centiday' END AS l_launch_date_precision,
      CASE o_orderstatus WHEN 'O' THEN 'Ghadr 1' ELSE 'V' || o_custkey END AS l_lv_name,
      CASE o_orderstatus WHEN 'P' THEN NULL ELSE 'B' END AS l_lv_variant,
      o_orderpriority AS l_flight_id, o_orderstatus AS l_mission,
      CASE o_orderstatus WHEN 'F' THEN 'SS-083' WHEN 'O' THEN 'P' || o_custkey ELSE NULL END AS l_p_code,
      CASE WHEN o_orderstatus = 'O' THEN 'GIK-5' WHEN o_orderstatus = 'P' THEN 'S' || o_custkey
        WHEN o_orderpriority = '1-URGENT' THEN 'CCA' ELSE 'CC' END AS l_launch_site_lp_site_code,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'LC46' WHEN '2-HIGH' THEN 'LC603' WHEN '3-MEDIUM' THEN 'LC81/23' ELSE 'L1' END
        AS l_launch_pad_lp_code,
      CASE o_orderstatus WHEN 'O' THEN 'CEL' WHEN 'F' THEN 'KMR' ELSE NULL END AS l_ascent_site_lp_site_code,
      CASE o_orderstatus WHEN 'F' THEN 'LP1' ELSE 'X' END AS l_ascent_pad_lp_code,
      CAST(o_custkey AS DOUBLE) AS l_apogee, CAST(2000000 AS DOUBLE) AS l_range, o_orderstatus AS l_dest,
      CASE o_orderstatus WHEN 'F' THEN 'A' WHEN 'P' THEN 'D' ELSE 'O' END AS l_launch_category,
      CASE o_orderstatus WHEN 'F' THEN 'F' WHEN 'P' THEN 'U' ELSE 'S' END AS l_launch_status,
      CASE o_orderstatus WHEN 'F' THEN CAST(75 AS DOUBLE) END AS l_launch_success_fraction,
      CASE o_orderstatus WHEN 'O' THEN 'C' WHEN 'P' THEN 'G' END AS l_launch_service_type,
      o_orderpriority AS l_category, 'D' || o_custkey AS l_primary_r_cite,
      {nulls("l_flight l_flightcode l_apoflag l_rangeflag l_orbpay l_fail_code l_additional_r_cite l_notes")}
    FROM orders""",
)
def launch(t: Tables) -> DataFrame:
    return recipes.launch(Inputs({"launch": cells.launch(t)}))


@query(
    "table_launch_agency_org",
    """
    SELECT 'T' || o_orderkey AS lao_l_launch_tag, unnest(['C' || o_custkey, 'NASA']) AS lao_o_code
    FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
def launch_agency_org(t: Tables) -> DataFrame:
    return recipes.launch_agency_org(Inputs({"launch": cells.launch(t)}))


@query(
    "table_launch_payload_org",
    """
    SELECT 'T' || o_orderkey AS lpo_l_launch_tag, unnest(['C' || o_custkey, 'Lab']) AS lpo_o_code
    FROM orders WHERE o_orderstatus = 'F'""",
)
def launch_payload_org(t: Tables) -> DataFrame:
    return recipes.launch_payload_org(Inputs({"launch": cells.launch(t)}))


@query(
    "table_launch_investigator",
    """
    SELECT 'T' || o_orderkey AS li_l_launch_tag, unnest(['Smith' || o_custkey, 'Jones']) AS li_investigator
    FROM orders WHERE o_orderstatus = 'F'""",
)
def launch_investigator(t: Tables) -> DataFrame:
    return recipes.launch_investigator(Inputs({"launch": cells.launch(t)}))


@query(
    "table_world",
    f"""
    SELECT 'W' AS w_id, '(' || s_suppkey || ')' AS w_idname, s_name AS w_name, s_acctbal AS w_radius,
      CAST(s_suppkey || 'E24' AS DOUBLE) AS w_mass,
      d + INTERVAL 23415 SECOND AS w_epoch, 'Second' AS w_epoch_precision, CAST(s_nationkey AS DOUBLE) AS w_rotperiod,
      CAST(CAST(s_nationkey AS DECIMAL(9, 0)) * 365.26 AS DOUBLE) AS w_orbperiod,
      CASE WHEN s_acctbal < 0 THEN NULL ELSE 'Ast' END AS w_wtype,
      CASE WHEN s_acctbal < 0 THEN 'Sun' WHEN s_nationkey < 5 THEN 'Earth-Moon System' WHEN s_nationkey < 10 THEN 'Sun'
        ELSE 'Supplier#' || lpad(CAST(s_nationkey AS VARCHAR), 9, '0') END AS w_primary_w_name,
      CASE WHEN s_acctbal < 0 THEN CAST(s_nationkey AS DOUBLE) END AS w_spin_rho,
      CASE WHEN s_acctbal < 0 THEN CAST(s_nationkey || 'E-3' AS DOUBLE) END AS w_spin_j2,
      CASE WHEN s_acctbal < 0 THEN 'f' || s_nationkey END AS w_spin_pole_function,
      {nulls("w_altname w_ephemeris w_spin_spin_function w_spin_init_function w_spin_jfile")},
      {nulls("w_polar_radius w_semimajoraxis w_periapsis w_ecc w_inc w_node w_peri w_m w_spin_intertial_factor w_spin_icrs_position_ra", "DOUBLE")},
      {nulls("w_spin_icrs_position_dec w_spin_meridian w_spin_rate w_spin_j4 w_spin_j6 w_spin_pole_ra_rate w_spin_pole_dec_rate", "DOUBLE")}
    FROM {key_day("supplier", "s_suppkey")}""",
)
def world(t: Tables) -> DataFrame:
    return recipes.world(Inputs({"worlds": cells.worlds(t), "spin": cells.spin(t)}))


@query(
    "table_satellite",
    f"""
    SELECT {cells.OBJECT_CATALOG} AS s_catalog,
      'J' || l_orderkey || '-' || l_linenumber AS s_jcat, CAST(l_partkey AS VARCHAR) AS s_satcat,
      CASE WHEN l_linenumber = 7 THEN NULL ELSE 'T' || l_orderkey END AS s_l_launch_tag,
      year(l_shipdate) || ' ' || l_linenumber AS s_piece, l_returnflag AS s_type_byte_1, l_linestatus AS s_type_byte_4,
      'X' AS s_type_byte_5, {nulls("s_type_byte_2 s_type_byte_3 s_type_byte_6 s_type_byte_7 s_type_byte_8 s_type_byte_9")},
      'Item ' || l_partkey AS s_name, l_shipdate AS s_ldate, 'Day' AS s_ldate_precision,
      CASE l_linenumber WHEN 1 THEN 'Sun-Earth L1' WHEN 2 THEN 'Earth' ELSE 'J' || l_orderkey || '-1' END AS s_parent_s_jcat_or_w_name,
      CASE WHEN l_linenumber > 2 THEN 'port' || l_linenumber END AS s_parent_port,
      CASE WHEN l_linenumber = 2 THEN '*' END AS s_parent_flag,
      l_shipdate + to_minutes(CAST(l_linenumber * 60 + CAST(l_quantity AS INTEGER) AS BIGINT)) AS s_sdate,
      CASE l_linestatus WHEN 'F' THEN 'Minutes' ELSE 'Minute' END AS s_sdate_precision,
      'Earth' AS s_primary_w_name,
      CASE WHEN month(l_shipdate) = 3 THEN date_trunc('month', l_shipdate) ELSE date_trunc('year', l_shipdate) END AS s_ddate,
      CASE WHEN month(l_shipdate) = 3 THEN 'Month' ELSE 'Year' END AS s_ddate_precision,
      l_linestatus AS s_status, CASE WHEN l_linenumber = 1 THEN NULL ELSE 'C' || l_suppkey END AS s_state_o_code,
      l_quantity AS s_mass, l_returnflag AS s_massflag, l_discount AS s_drymass, CAST(l_linenumber * 1000000 AS DOUBLE) AS s_totmass,
      l_tax AS s_length, date_trunc('quarter', l_shipdate) AS s_odate, 'Quarter' AS s_odate_precision,
      l_extendedprice AS s_perigee, CASE WHEN l_discount = 0 THEN CAST('inf' AS DOUBLE) ELSE l_extendedprice END AS s_apogee,
      CAST(l_linenumber AS DOUBLE) AS s_inc, l_returnflag || l_linestatus AS s_oporbit,
      CASE WHEN l_linenumber = 1 THEN (SELECT o_orderpriority FROM orders WHERE o_orderkey = l_orderkey) END AS s_unicode_name,
      {nulls("s_diameter s_span", "DOUBLE")},
      {nulls("s_plname s_dest s_bus s_motor s_dryflag s_totflag s_lflag s_dflag s_spanflag s_shape s_pf s_af s_if s_oqual s_altnames")}
    FROM lineitem""",
)
def satellite(t: Tables) -> DataFrame:
    return recipes.satellite(Inputs({"object": cells.objects(t), "usatcat": cells.usatcat(t)}))


@query(
    "table_satellite_owner_org",
    f"""
    SELECT 'J' || l_orderkey || '-' || l_linenumber AS soo_s_jcat,
      unnest(CASE l_linenumber WHEN 1 THEN [] WHEN 2 THEN ['NROC'] ELSE ['C' || l_suppkey, 'N' || l_linenumber] END) AS soo_o_code
    FROM lineitem WHERE {MAIN_CATALOG}""",
)
def satellite_owner_org(t: Tables) -> DataFrame:
    return recipes.satellite_owner_org(Inputs({"object": cells.objects(t)}))


@query(
    "table_satellite_manufacturer_org",
    f"""
    SELECT 'J' || l_orderkey || '-' || l_linenumber AS smo_s_jcat, unnest(['C' || l_suppkey, 'M' || l_linenumber]) AS smo_o_code
    FROM lineitem WHERE {MAIN_CATALOG} AND l_linestatus = 'O'""",
)
def satellite_manufacturer_org(t: Tables) -> DataFrame:
    return recipes.satellite_manufacturer_org(Inputs({"object": cells.objects(t)}))


@query(
    "table_payload",
    f"""
    SELECT {cells.PAYLOAD_CATALOG} AS pay_catalog, 'E' || event_id AS pay_jcat,
      CAST(user_id AS VARCHAR) AS pay_piece, event_type AS pay_name,
      CASE event_type WHEN 'error' THEN TIMESTAMP '2022-02-27' ELSE date_trunc('day', ts) END AS pay_ldate, 'Day' AS pay_ldate_precision,
      date_trunc('second', ts) AS pay_top, 'Seconds' AS pay_top_precision,
      CASE event_type WHEN 'view' THEN NULL ELSE date_trunc('month', ts) END AS pay_tdate,
      CASE event_type WHEN 'view' THEN NULL ELSE 'Month' END AS pay_tdate_precision,
      CASE event_type WHEN 'click' THEN 'M' ELSE 'N' END AS pay_mvr, event_type AS pay_class,
      CASE event_type WHEN 'view' THEN NULL ELSE 'C' || user_id END AS pay_unstate_o_code,
      CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'Yes' ELSE 'No' END AS pay_is_registered,
      value AS pay_unperiod, date_trunc('day', ts) + INTERVAL 12 HOUR AS pay_dispepoch, 'Hour' AS pay_dispepoch_precision,
      CAST(user_id AS DOUBLE) AS pay_dispinc, {nulls("pay_tlast", "TIMESTAMP")},
      {nulls("pay_unperigee pay_unapogee pay_uninc pay_dispperi pay_dispapo", "DOUBLE")},
      {nulls("pay_tlast_precision pay_tf pay_program pay_plane pay_att pay_result pay_control pay_unreg pay_comment")}
    FROM events""",
)
def payload(t: Tables) -> DataFrame:
    return recipes.payload(Inputs({"payload": cells.payloads(t)}))


@query(
    "table_payload_category",
    """
    SELECT 'E' || event_id AS pc_pay_jcat, unnest(CASE event_type WHEN 'click' THEN ['COM', 'U' || user_id] ELSE ['SCI', event_type] END) AS pc_category,
      unnest(CASE event_type WHEN 'click' THEN ['Yes', 'No'] ELSE ['No', 'Yes'] END) AS pc_is_secret
    FROM events WHERE event_type <> 'view'""",
)
def payload_category(t: Tables) -> DataFrame:
    return recipes.payload_category(Inputs({"payload": cells.payloads(t)}))


@query(
    "table_payload_discipline",
    "SELECT 'E' || event_id AS pd_pay_jcat, unnest(['AS', 'EO']) AS pd_discipline FROM events WHERE event_type = 'view'",
)
def payload_discipline(t: Tables) -> DataFrame:
    return recipes.payload_discipline(Inputs({"payload": cells.payloads(t)}))


@query(
    "table_engine",
    f"""
    SELECT p_partkey + 1 AS e_id, p_name AS e_name, p_brand AS e_family, p_retailprice AS e_mass,
      CAST(p_size * 1000000 AS DOUBLE) AS e_thrust, CASE p_type WHEN 'SMALL' THEN NULL ELSE date_trunc('month', d) END AS e_date,
      CASE p_type WHEN 'SMALL' THEN NULL ELSE 'Month' END AS e_date_precision, p_type AS e_usage,
      {nulls("e_impulse e_isp e_duration e_chambers", "DOUBLE")},
      {nulls("e_alt_name e_mflag e_impflag e_tflag e_ispflag e_durflag e_group")}
    FROM {key_day("part", "p_partkey")}""",
)
def engine(t: Tables) -> DataFrame:
    return recipes.engine(Inputs({"engines": cells.engines(t)}))


@query(
    "table_engine_propellant",
    """
    SELECT p_partkey + 1 AS ep_e_id, unnest(['LOX', 'RFNA AK-20F']) AS ep_propellant, 'oxidizer' AS ep_fuel_or_oxidizer
    FROM part WHERE p_type <> 'SMALL'
    UNION ALL
    SELECT p_partkey + 1, unnest(CASE p_type WHEN 'PROMO' THEN ['JPX (JP-4 and UDMH)'] WHEN 'SMALL' THEN ['MMH']
      ELSE ['AlTP-H-3062M', 'F' || p_size] END), 'fuel' FROM part""",
)
def engine_propellant(t: Tables) -> DataFrame:
    return recipes.engine_propellant(Inputs({"engines": cells.engines(t)}))


@query(
    "table_engine_manufacturer",
    """
    SELECT p_partkey + 1 AS em_e_id, unnest(CASE p_type WHEN 'PROMO' THEN ['IRGC', 'SIENV'] ELSE ['C' || p_size, 'IR'] END)
      AS em_manufacturer_o_code FROM part WHERE p_type <> 'SMALL'""",
)
def engine_manufacturer(t: Tables) -> DataFrame:
    return recipes.engine_manufacturer(Inputs({"engines": cells.engines(t)}))


def stage_table(t: Tables) -> DataFrame:
    built = {"engine": recipes.engine(Inputs({"engines": cells.engines(t)}))}
    return recipes.stage(Inputs({"stages": cells.stages(t)}, built))


@query(
    "table_stage",
    f"""
    WITH first_engine AS (SELECT p_name, min(p_partkey + 1) AS e_id FROM part GROUP BY p_name)
    SELECT 'G' || p_partkey AS stage_name, p_brand AS stage_lvf_family, CAST(p_size AS DOUBLE) AS stage_length,
      p_retailprice AS stage_launch_mass, CASE p_type WHEN 'PROMO' THEN NULL ELSE e_id END AS stage_e_id,
      CAST(p_size AS VARCHAR) AS stage_neng, {nulls("stage_diameter stage_dry_mass stage_thrust stage_duration", "DOUBLE")},
      {nulls("stage_alt_name")}
    FROM part JOIN first_engine USING (p_name) WHERE p_type <> 'SMALL'""",
)
def stage(t: Tables) -> DataFrame:
    return stage_table(t)


@query(
    "table_stage_manufacturer",
    """
    SELECT 'G' || p_partkey AS sm_stage_name, unnest(CASE p_type WHEN 'PROMO' THEN ['SAST', 'ARMT'] WHEN 'LARGE' THEN ['C1']
      ELSE ['C' || p_size] END) AS sm_manufacturer_o_code FROM part WHERE p_type NOT IN ('SMALL', 'MEDIUM')""",
)
def stage_manufacturer(t: Tables) -> DataFrame:
    return recipes.stage_manufacturer(Inputs({"stages": cells.stages(t)}))


@query(
    "table_launch_vehicle_stage",
    f"""
    WITH named AS (
      SELECT *, CASE l_returnflag WHEN 'A' THEN 'Fairing' ELSE 'G' || l_partkey END AS raw,
        l_returnflag <> 'A' AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'SMALL') AS is_stage FROM lineitem)
    SELECT 'V' || l_partkey AS lvs_lv_name, CASE l_linestatus WHEN 'F' THEN NULL ELSE l_returnflag END AS lvs_lv_variant,
      CAST(l_linenumber AS VARCHAR) AS lvs_stage_no, CASE WHEN is_stage THEN raw END AS lvs_stage_name,
      CASE WHEN NOT is_stage THEN raw END AS lvs_stage_type, l_quantity AS lvs_multiplicity,
      l_extendedprice AS lvs_stage_impulse, CAST(l_linenumber * 1000000 AS DOUBLE) AS lvs_stage_perigee,
      {nulls("lvs_stage_apogee", "DOUBLE")}, {nulls("lvs_qualifier lvs_dummy lvs_perigee_qual")}
    FROM named""",
)
def launch_vehicle_stage(t: Tables) -> DataFrame:
    return recipes.launch_vehicle_stage(Inputs({"lvs": cells.lvs(t)}, {"stage": stage_table(t)}))
