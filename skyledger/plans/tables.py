"""The thirty tables: how each is built, its keys and its references."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.codes import code_positions, group_parts, is_orbital, launch_code_parts
from skyledger.functions.lists import list_items
from skyledger.functions.text import (
    NULL_MARK,
    after_first_blank,
    after_last,
    before_last,
    clean,
    clean_sql,
    remove,
    strip_end,
    yes_no,
)
from skyledger.operators.corrections import Case, Fix, Regex, Replace, Strip, correct, exact
from skyledger.operators.lookups import left_detail, rebalanced, route, with_membership, with_surrogate
from skyledger.plans.shape import (
    AT,
    BAD,
    Inputs,
    Reference,
    TableSpec,
    bad_cell,
    bridge,
    cleaned,
    entity,
    hidden,
    token_map,
    typed,
    visible,
    with_bad_cells,
)

# Organization types with their meaning, by group.
ORGANIZATION_TYPES = {
    "States and similar entities": {
        "CY": "Country (i.e. nation-state or autonomous region)",
        "CYP": "Country Province",
        "IGO": "Intergovernmental organization. Treated as equivalent to a country for the purposes of tabulations of launches by country etc.",
        "AP": "Astronomical Polity: e.g. Luna, Mars. Used for the 'country' field for locations that are not on Earth and therefore don't have a country.",
    },
    "Manufacturers": {
        "E": "Engine manufacturer",
        "LV": "Launch vehicle manufacturer",
        "W": "Meteorological rocket launch agency or manufacturer",
        "PL": "Payload manufacturer",
    },
    "Operators": {
        "LA": "Launch Agency",
        "S": "Suborbital payload operator",
        "O": "Payload owner",
        "P": "Parent organization of another entry",
    },
    "Launch origin or destination": {
        "LS": "Launch site",
        "LP": "Launch position",
        "LC": "Launch cruise",
        "LZ": "Launch zone",
        "TGT": "Suborbital target area",
    },
}

# Families that launch vehicles use but the family file lacks.
EXTRA_FAMILIES = ("Spectrum", "PrSM")

# Whole-value and whole-item corrections, wrong to right; None removes.
ORGANIZATION_PARENTS = {"MOTI/TMI": "MOTI", "HISD/LOR": "LOR"}
LAUNCH_POINT_ORGS = {"PRC": "CN", "DNVG": "DVNG"}
LAUNCH_VEHICLE_ORGS = {"ROKTSN": "ROKSN", "TIAB": "TIANB", "NCSIST": None}
LAUNCH_VEHICLES = {"Minotaur-C 3210": "Minotaur C", "Ghadr-110": "Ghadr 1", "Angara A5/Persei": "Angara A5"}
LAUNCH_GROUPS = {"1969-F13": "G", "2000-048": "CO"}
WORLD_PRIMARIES = {"Sol": "Sun", "EMB": "Earth-Moon System"}
SATELLITE_PARENTS = {
    "SEL1": "Sun-Earth L1",
    "SEL2": "Sun-Earth L2",
    "HCO": "Sun",
    "(243)": "Ida",
    "(253)": "Mathilde",
    "(951)": "Gaspra",
    "67P/": "Churyumov-Gerasimenko",
    "81P/Wild2": "Wild 2",
    "9P/Tempel1": "Tempel 1",
    "EML1": "Earth-Moon L1",
    "EML2": "Earth-Moon L2",
}
PROPELLANTS = {
    "Al TP-H-334": "Al TP-H-3340",
    "AlTP-H-3062": "AlTP-H-3062M",
    "RFNA AK-20": "RFNA AK-20F",
    "Vinyl Isobutyl ethe": "Vinyl Isobutyl ether",
}
ENGINE_MANUFACTURERS = {"Zulfiqar": "IRGC", "TKSVA": "OKB52", "IRCPS": "NGISP", "IRAN": "IR", "SNC": "SIENV"}
STAGE_MANUFACTURERS = {"SALT": "SAST"}

# Launch sites renamed over time, former name to current name.
SITE_RENAMES = {
    "NIIP-53": "GIK-1",
    "NIIP-5": "GIK-5",
    "GNIIPV": "GIK-1",
    "GIP-53": "GNIIP",
    "GTsMP-4": "GTsP-4",
    "SDSC": "SHAR",
    "WIMB": "NAOTS",
    "VSFBS": "VS",
    "VSFB": "V",
    "USC": "KASC",
}

# Object rows with a repeated world name, by raw mass.
REPEATED_WORLDS = (("(47171)", "61200?"), ("(617)", "1360"), ("(79360)", "46600?"), ("2017 OF69", "100000?"))

# Launches whose payload organization is not yet in the organization file.
UNLISTED_PAYLOAD_ORGS = ("2023-S29", "2024-S76", "2024-S85")
UNLISTED_ORG = "RIT"

# Stray three-digit years at the end of launch tags.
_TAG_TAIL = r"\s+(194|195|196|197|198|199|200|201|202)$"

SITE, PAD = "l_launch_site_lp_site_code", "l_launch_pad_lp_code"
ASCENT_SITE, ASCENT_PAD = "l_ascent_site_lp_site_code", "l_ascent_pad_lp_code"


def _at(site: str, pads: tuple[str, ...], then: str | None, strip: str = "") -> Case:
    return Case(then, when={SITE: (site,), PAD: pads}, strip=strip)


# Corrections of launch rows.
LAUNCH_FIXES = (
    exact("l_lv_name", LAUNCH_VEHICLES),
    Fix("l_lv_variant", steps=(Replace("?"),)),
    Fix("l_p_code", cases=(Case("SS-083", when={"l_p_code": ("SS-088",)}, strip="?"),), steps=(Strip("?"),)),
    Fix(
        SITE,
        cases=(
            _at("PSCA", ("LP2", "LP2?"), "KLC"),
            _at("SPFLA", ("LC46", "SLC46"), "SPFL"),
            _at("CC", ("LC46",), "CCA"),
            *(Case(current, when={SITE: (former,)}, strip="?") for former, current in SITE_RENAMES.items()),
        ),
        steps=(Strip("?"),),
    ),
    Fix(
        PAD,
        cases=(
            _at("SPFL", ("LC47",), "SLC47"),
            _at("JQ", ("LC43/95A",), "LC43/95", strip="?"),
            _at("SPFLA", ("LC46", "SLC46"), "SLC46"),
            _at("GUAMA", ("LP1",), "LA1"),
            _at("JQ", ("LC43/96A",), "LC43/96"),
            _at("PF", ("Pad 3 L2",), "LC3"),
            _at("KRASK", ("YEYSK",), None),
            _at("VOLR", ("BELG",), None),
        ),
        steps=(Strip("?"), Regex("^LC603 +$", "LC603"), Regex("^LC81$", "LC81/23")),
    ),
    Fix(ASCENT_SITE, cases=(Case("CEL", when={ASCENT_SITE: ("DGAEML",)}, strip="?"),), steps=(Strip("?"),)),
    Fix(
        ASCENT_PAD,
        cases=(
            Case("LP1", when={ASCENT_SITE: ("KMR",), ASCENT_PAD: ("Lp1",)}),
            Case("X1", when={ASCENT_SITE: ("A51",), ASCENT_PAD: ("X",)}),
        ),
        steps=(Strip("?"),),
    ),
)

# Corrections of payload organizations in single launches.
PAYLOAD_ORG_FIX = Fix(
    "lpo_o_code",
    cases=(
        Case("LPARL", when={"lpo_l_launch_tag": ("1964-S509",), "lpo_o_code": ("PARL",)}),
        Case("APGC", when={"lpo_l_launch_tag": ("1965-W199",), "lpo_o_code": ("AGPC",)}),
        Case("CLEM", when={"lpo_l_launch_tag": ("2024-S69", "2024-S70"), "lpo_o_code": ("Clemson",)}),
        Case("UMI", when={"lpo_l_launch_tag": ("2024-S86",), "lpo_o_code": ("UM",)}),
        Case("RLABU", when={"lpo_l_launch_tag": UNLISTED_PAYLOAD_ORGS, "lpo_o_code": ("C",)}),
    ),
)

# Corrections of object rows. Days of zero mean the month.
SATELLITE_FIXES = (
    Fix(
        "s_l_launch_tag",
        cases=(
            Case(None, when={"s_l_launch_tag": ("-          -", "-          UNK")}),
            Case(None, like={"s_l_launch_tag": "-" + _TAG_TAIL}),
        ),
        steps=(Regex(_TAG_TAIL),),
    ),
    Fix(
        "s_sdate",
        cases=(
            Case("2002 Jan 16 0705", when={"s_sdate": ("2002 Jan 16 0705s",)}),
            Case("2000 Nov  5 2000?", when={"s_sdate": ("2000 Nov  5  2000?",)}),
        ),
        steps=(Regex("(Jan|Mar|Apr)  0$|(Jan) 00$", "$1$2", like="% %0"),),
    ),
    Fix(
        "s_ddate",
        cases=(
            Case("2009 Jan 01", when={"s_ddate": ("2009 Jan  0",)}),
            Case("2024 Dec 16 1025?", when={"s_ddate": ("2024 Dec 16  1025?",)}),
            Case("2023 Mar 19 0048?", when={"s_ddate": ("2023 Mar 19 0048??",)}),
            Case("2025 Feb 25 0356", when={"s_ddate": ("2025 JFeb 25 0356",)}),
        ),
        steps=(Regex("Mar  0$", "Mar", like="%Mar  0"),),
    ),
    exact("s_odate", {"2021 Fen 14": "2021 Feb 14", "2021 Fen  7": "2021 Feb  7"}),
)

# Corrections of payload rows.
PAYLOAD_FIXES = (
    exact("pay_ldate", {"22 Feb 27": "2022 Feb 27"}),
    exact("pay_tdate", {"*": None, "* E": None, "2022  Mar 27?": "2022 Mar 27?"}),
    exact("pay_mvr", {"m": "M"}),
)

_PLACE = ("TStart", "TStop"), ("Longitude", "Latitude", "Error")


def _undoubted(c: Column) -> Column:
    return remove(c, "?")


def organization_type(spark: SparkSession) -> DataFrame:
    rows = [(code, text, group) for group, types in ORGANIZATION_TYPES.items() for code, text in types.items()]
    return spark.createDataFrame(rows, "ot_type string, ot_meaning string, ot_group string")


def organization(x: Inputs) -> DataFrame:
    dates, numbers = _PLACE
    columns = [c for c in visible(x.staged["orgs"]) if c != "Type"]
    rename = {"Parent": "o_parent_o_code"}
    fixes = [exact("o_parent_o_code", ORGANIZATION_PARENTS)]
    return entity(x.staged["orgs"], "o_", columns, rename, fixes, numbers=numbers, dates=dates, strict=x.strict)


def organization_org_type(x: Inputs) -> DataFrame:
    return bridge(x.staged["orgs"], {"oot_o_code": "Code"}, "Type", "oot_ot_type")


def _early_start(column: str) -> Fix:
    return Fix(column, steps=(Replace("1974 Nov  6:", "1974 Nov  6"),))


def site(x: Inputs) -> DataFrame:
    dates, numbers = _PLACE
    columns = [c for c in visible(x.staged["sites"]) if c not in ("Code", "Parent")]
    fixes = [_early_start("site_tstart")]
    return entity(
        x.staged["sites"], "site_", columns, {"Site": "site_code"}, fixes, numbers=numbers, dates=dates, strict=x.strict
    )


def site_org(x: Inputs) -> DataFrame:
    return bridge(x.staged["sites"], {"so_site_code": "Site"}, "Parent", "so_o_code", tidy=_undoubted)


def platform(x: Inputs) -> DataFrame:
    dates, numbers = _PLACE
    columns = [c for c in visible(x.staged["platforms"]) if c != "Parent"]
    return entity(x.staged["platforms"], "p_", columns, numbers=numbers, dates=dates, strict=x.strict)


def platform_org(x: Inputs) -> DataFrame:
    return bridge(x.staged["platforms"], {"po_p_code": "Code"}, "Parent", "po_o_code", tidy=_undoubted)


def launch_point(x: Inputs) -> DataFrame:
    dates, numbers = _PLACE
    columns = [c for c in visible(x.staged["lp"]) if c != "Parent"]
    fixes = [_early_start("lp_tstart"), Fix("lp_tstop", steps=(Replace("DZK3  -"),))]
    return entity(
        x.staged["lp"], "lp_", columns, {"Site": "lp_site_code"}, fixes, numbers=numbers, dates=dates, strict=x.strict
    )


def launch_point_org(x: Inputs) -> DataFrame:
    keys = {"lpo_site_code": "Site", "lpo_lp_code": "Code"}
    return bridge(x.staged["lp"], keys, "Parent", "lpo_o_code", tidy=token_map(LAUNCH_POINT_ORGS, _undoubted))


def launch_vehicle_family(x: Inputs) -> DataFrame:
    extra = x.spark.createDataFrame([(name,) for name in EXTRA_FAMILIES], "lvf_family string")
    rows = x.staged["family"].filter(F.col("Family") != NULL_MARK)
    listed = rows.select(clean(F.col("Family")).alias("lvf_family"), *hidden(rows)).unionByName(extra, allowMissingColumns=True)
    first = [F.min(c).alias(c) for c in hidden(rows)]
    return listed.groupBy("lvf_family").agg(*first) if first else listed.distinct()


def launch_vehicle(x: Inputs) -> DataFrame:
    columns = [c for c in visible(x.staged["lv"]) if c != "LV_Manufacturer"]
    numbers = (
        "LV_Min_Stage", "LV_Max_Stage", "Length", "Diameter", "Launch_Mass",
        "LEO_Capacity", "GTO_Capacity", "TO_Thrust", "Apogee", "Range",
    )
    return entity(x.staged["lv"], "lv_", columns, {"LV_Family": "lv_lvf_family"}, numbers=numbers, strict=x.strict)


def launch_vehicle_org(x: Inputs) -> DataFrame:
    keys = {"lvo_lv_name": "LV_Name", "lvo_lv_variant": "LV_Variant"}
    return bridge(x.staged["lv"], keys, "LV_Manufacturer", "lvo_o_code", tidy=token_map(LAUNCH_VEHICLE_ORGS, _undoubted))


def reference(x: Inputs) -> DataFrame:
    return entity(x.staged["refs"], "r_", visible(x.staged["refs"]), strict=x.strict)


def _orbital(code: Column, strict: bool) -> Column:
    """1 or 0; null for a launch without a code, or with a status but no category."""
    return F.when(code != "-S", is_orbital(code, strict))


def launch(x: Inputs) -> DataFrame:
    rename = {
        "LV_Type": "l_lv_name",
        "Variant": "l_lv_variant",
        "Platform": "l_p_code",
        "Launch_Tag": "l_launch_tag",
        "Launch_JD": "l_launch_jd",
        "Launch_Date": "l_launch_date",
        "Launch_Site": SITE,
        "Launch_Pad": PAD,
        "Ascent_Site": ASCENT_SITE,
        "Ascent_Pad": ASCENT_PAD,
        "LaunchCode": "l_launch_code",
        "FailCode": "l_fail_code",
        "LTCite": "l_primary_r_cite",
        "Cite": "l_additional_r_cite",
    }
    df = correct(cleaned(x.staged["launch"], "l_", visible(x.staged["launch"]), rename), LAUNCH_FIXES)
    code = F.col("l_launch_code")
    parts = launch_code_parts(code)
    group = F.col("l_group")
    for tag, value in LAUNCH_GROUPS.items():
        group = F.when(F.col("l_launch_tag") == tag, F.lit(value)).otherwise(group)
    df = df.withColumns(
        {
            "l_launch_category": parts["category"],
            "l_launch_status": parts["status"],
            "l_launch_success_fraction": parts["success_fraction"],
            "l_group": group,
            "__orbital": _orbital(code, x.strict),
        }
    ).withColumn("l_launch_service_type", group_parts(F.col("l_group"), F.col("__orbital"))["service_type"])
    df = df.select(
        "l_launch_tag", "l_launch_jd", "l_launch_date", "l_lv_name", "l_lv_variant", "l_flight_id", "l_flight",
        "l_mission", "l_flightcode", "l_p_code", SITE, PAD, ASCENT_SITE, ASCENT_PAD, "l_apogee", "l_apoflag",
        "l_range", "l_rangeflag", "l_dest", "l_orbpay", "l_launch_category", "l_launch_status",
        "l_launch_success_fraction", "l_fail_code", "l_launch_service_type", "l_category", "l_primary_r_cite",
        "l_additional_r_cite", "l_notes", *hidden(df), *([] if x.strict else ["__orbital", "l_launch_code"]),
    )
    if not x.strict:
        unknown = "CASE WHEN `l_launch_code` <> '-S' AND `__orbital` IS NULL THEN 'not a launch code' END"
        bad = with_bad_cells(df, [bad_cell("l_launch_code", unknown)])
        df = df.withColumn(BAD, F.expr(bad)).drop("__orbital", "l_launch_code")
    numbers = ("l_launch_jd", "l_apogee", "l_range", "l_launch_success_fraction")
    return typed(df, numbers, dates=("l_launch_date",), strict=x.strict)


def launch_agency_org(x: Inputs) -> DataFrame:
    return bridge(x.staged["launch"], {"lao_l_launch_tag": "Launch_Tag"}, "Agency", "lao_o_code", prepare=_undoubted)


def _suborbital(x: Inputs) -> DataFrame:
    """Suborbital launches with payload groups. Without a code nobody can tell: a
    strict run refuses such a launch, a lenient one leaves it to the check of launches."""
    staged = x.staged["launch"].filter(F.col("Group") != NULL_MARK)
    code = clean(F.col("LaunchCode"))
    orbital = _orbital(code, x.strict)
    if x.strict:
        refused = F.raise_error(F.concat(F.lit("Launch without a code: "), F.col("Launch_Tag"))).cast("int")
        orbital = F.when(code.isNull(), refused).otherwise(orbital)
    return staged.filter(orbital == 0)


def launch_payload_org(x: Inputs) -> DataFrame:
    rows = bridge(
        _suborbital(x),
        {"lpo_l_launch_tag": "Launch_Tag"},
        "Group",
        "lpo_o_code",
        prepare=lambda c: before_last(_undoubted(c), "/"),
    )
    rows = correct(rows, [PAYLOAD_ORG_FIX])
    unlisted = F.col("lpo_l_launch_tag").isin(*UNLISTED_PAYLOAD_ORGS) & (F.col("lpo_o_code") == UNLISTED_ORG)
    return rows.filter(~unlisted)


def launch_investigator(x: Inputs) -> DataFrame:
    return bridge(
        _suborbital(x),
        {"li_l_launch_tag": "Launch_Tag"},
        "Group",
        "li_investigator",
        prepare=lambda c: after_last(_undoubted(c), "/"),
        delimiters=",",
    )


def world(x: Inputs) -> DataFrame:
    rename = {
        "IDT": "w_id",
        "PolarRadius": "w_polar_radius",
        "Primary": "w_primary_w_name",
    }
    # Spelled out pair by pair: an unknown comparison drops the row, as in a null-aware NOT IN.
    repeated = F.lit(False)
    for name, mass in REPEATED_WORLDS:
        repeated = repeated | ((F.col("IDName") == name) & (F.col("Mass") == mass))
    worlds = cleaned(x.staged["worlds"].filter(~repeated), "w_", visible(x.staged["worlds"]), rename)
    worlds = worlds.withColumn("w_primary_w_name", F.coalesce("w_primary_w_name", F.lit("Sun")))
    worlds = correct(
        worlds,
        [
            Fix(
                "w_epoch",
                cases=(Case("BC 0146 Jun 28 0000:00", when={"w_epoch": ("0 Jun 28  0000:00",)}),),
                steps=(Regex("([0-9]+)  ([0-9]+)", "$1 $2"),),
            ),
            exact("w_primary_w_name", WORLD_PRIMARIES),
        ],
    )
    spin_names = {
        "IDName": "spin_idname",
        "Rho": "w_spin_rho",
        "IFac": "w_spin_intertial_factor",
        "PoleRA": "w_spin_icrs_position_ra",
        "PoleDec": "w_spin_icrs_position_dec",
        "Meridian": "w_spin_meridian",
        "SpinRate": "w_spin_rate",
        "J2": "w_spin_j2",
        "J4": "w_spin_j4",
        "J6": "w_spin_j6",
        "PoleRARate": "w_spin_pole_ra_rate",
        "PoleDecRate": "w_spin_pole_dec_rate",
        "PoleFunc": "w_spin_pole_function",
        "SpinFunc": "w_spin_spin_function",
        "InitFunc": "w_spin_init_function",
        "JFile": "w_spin_jfile",
    }
    spin = cleaned(x.staged["spin"].drop(AT), "w_spin_", spin_names, spin_names)
    joined = left_detail(worlds, spin, "w_idname", "spin_idname")
    texts = ("w_spin_pole_function", "w_spin_spin_function", "w_spin_init_function", "w_spin_jfile")
    numbers = [
        "w_radius", "w_polar_radius", "w_mass", "w_semimajoraxis", "w_periapsis", "w_ecc", "w_inc", "w_node",
        "w_peri", "w_m", "w_rotperiod", "w_orbperiod",
        *[c for c in spin_names.values() if c.startswith("w_spin_") and c not in texts],
    ]
    head = [c for c in visible(joined) if not c.startswith("w_spin_") and c != "w_primary_w_name"]
    spins = [c for c in joined.columns if c.startswith("w_spin_")]
    return typed(joined.select(*head, "w_primary_w_name", *spins, *hidden(joined)), numbers, dates=("w_epoch",), strict=x.strict)


def satellite(x: Inputs) -> DataFrame:
    staged = x.staged["object"]
    bytes_ = [f"s_type_byte_{i}" for i in range(1, 10)]
    rename = {
        "Launch_Tag": "s_l_launch_tag",
        "Primary": "s_primary_w_name",
        "State": "s_state_o_code",
    }
    columns = [c for c in visible(staged) if c not in ("s_catalog", "Type", "Owner", "Manufacturer")]
    named = staged.selectExpr(
        "s_catalog",
        "Type",
        *[f"{clean_sql(c)} AS `{rename.get(c, f's_{c.lower()}')}`" for c in columns],
        *hidden(staged),
    )
    named = named.select(*[c for c in named.columns if c != "Type"], *code_positions(F.col("Type"), bytes_))
    parent = remove(F.regexp_extract("s_parent", "[^ ]+", 0), "*")
    df = correct(named, SATELLITE_FIXES).withColumns(
        {
            "s_parent_s_jcat_or_w_name": parent,
            "s_parent_port": after_first_blank(F.col("s_parent")),
            "s_parent_flag": F.when(F.col("s_parent").contains("*"), "*"),
        }
    )
    # Alternative names: repeated (id, name) pairs count once; different names of one id stay as rows.
    other = x.staged["usatcat"].select(clean(F.col("JCAT")).alias("__jcat"), clean(F.col("Name")).alias("s_unicode_name"))
    df = left_detail(df, rebalanced(other.distinct()), "s_jcat", "__jcat")
    df = correct(df, [exact("s_parent_s_jcat_or_w_name", SATELLITE_PARENTS)])
    # Piece to name, with the parsed type and parent where their text stood.
    order = ["s_catalog"]
    for c in columns:
        name = rename.get(c, f"s_{c.lower()}")
        order += ["s_parent_s_jcat_or_w_name", "s_parent_port", "s_parent_flag"] if name == "s_parent" else [name]
        order += bytes_ if name == "s_piece" else []
    return typed(
        df.select(*order, "s_unicode_name", *hidden(df)),
        numbers=("s_mass", "s_drymass", "s_totmass", "s_length", "s_diameter", "s_span", "s_perigee", "s_inc"),
        doubles=("s_apogee",),
        dates=("s_ldate", "s_sdate", "s_ddate", "s_odate"),
        strict=x.strict,
    )


def _main_catalog(x: Inputs) -> DataFrame:
    return x.staged["object"].filter(F.col("s_catalog") == "satcat")


def satellite_owner_org(x: Inputs) -> DataFrame:
    def once(c: Column) -> Column:
        return F.when(c == "NROC/NROC", "NROC").otherwise(c)

    return bridge(_main_catalog(x), {"soo_s_jcat": "JCAT"}, "Owner", "soo_o_code", prepare=once, tidy=strip_end)


def satellite_manufacturer_org(x: Inputs) -> DataFrame:
    keys = {"smo_s_jcat": "JCAT"}
    return bridge(_main_catalog(x), keys, "Manufacturer", "smo_o_code", prepare=strip_end, tidy=strip_end)


def payload(x: Inputs) -> DataFrame:
    columns = [c for c in visible(x.staged["payload"]) if c not in ("pay_catalog", "Category", "Discipline")]
    df = correct(cleaned(x.staged["payload"], "pay_", ["pay_catalog", *columns]), PAYLOAD_FIXES)
    state = F.col("pay_unstate")
    registered = F.when(state.isNotNull(), yes_no(state.like("%[%]%")))
    replaced = {"pay_unstate": [remove(state, "*", "[", "]").alias("pay_unstate_o_code"), registered.alias("pay_is_registered")]}
    df = df.select(*[col for c in df.columns for col in replaced.get(c, [F.col(c)])])
    return typed(
        df,
        numbers=("pay_unperiod", "pay_unperigee", "pay_unapogee", "pay_uninc", "pay_dispperi", "pay_dispapo", "pay_dispinc"),
        dates=("pay_ldate", "pay_tlast", "pay_top", "pay_tdate", "pay_dispepoch"),
        strict=x.strict,
    )


def payload_category(x: Inputs) -> DataFrame:
    items = bridge(x.staged["payload"], {"pc_pay_jcat": "JCAT"}, "Category", "item", prepare=strip_end)
    secret = yes_no(F.col("item").contains("*"))
    name = strip_end(strip_end(F.col("item"), "?"), "*")
    return items.select("pc_pay_jcat", name.alias("pc_category"), secret.alias("pc_is_secret"), *hidden(items))


def payload_discipline(x: Inputs) -> DataFrame:
    return bridge(
        x.staged["payload"],
        {"pd_pay_jcat": "JCAT"},
        "Discipline",
        "pd_discipline",
        prepare=strip_end,
        tidy=lambda c: remove(c, "?", "*"),
    )


def engine(x: Inputs) -> DataFrame:
    staged = x.staged["engines"]
    columns = [c for c in visible(staged) if c not in ("line_number", "Manufacturer", "Oxidizer", "Fuel")]
    df = staged.selectExpr("line_number", *[f"{clean_sql(c)} AS `e_{c.lower()}`" for c in columns], *hidden(staged))
    numbers = ("e_mass", "e_impulse", "e_thrust", "e_isp", "e_duration", "e_chambers")
    return typed(df.withColumnRenamed("line_number", "e_id"), numbers, dates=("e_date",), strict=x.strict)


def engine_propellant(x: Inputs) -> DataFrame:
    """Both lists of an engine in one scan, each item tagged with its list."""
    def tagged(cell: str, tag: str) -> Column:
        # One propellant has a slash inside its name.
        whole = F.replace(F.col(cell), F.lit("JPX (JP-4/UDMH)"), F.lit("JPX (JP-4 and UDMH)"))
        items = F.when(F.col(cell) != NULL_MARK, list_items(_undoubted(whole)))
        return F.transform(F.coalesce(items, F.array().cast("array<string>")), lambda item: F.struct(item.alias("item"), F.lit(tag).alias("tag")))

    both = F.concat(tagged("Oxidizer", "oxidizer"), tagged("Fuel", "fuel"))
    staged = x.staged["engines"]
    rows = staged.select(F.col("line_number").alias("ep_e_id"), F.inline(both), *hidden(staged))
    return rows.select(
        "ep_e_id",
        token_map(PROPELLANTS)(F.trim("item")).alias("ep_propellant"),
        F.col("tag").alias("ep_fuel_or_oxidizer"),
        *hidden(rows),
    )


def engine_manufacturer(x: Inputs) -> DataFrame:
    tidy = token_map(ENGINE_MANUFACTURERS, _undoubted)
    return bridge(x.staged["engines"], {"em_e_id": "line_number"}, "Manufacturer", "em_manufacturer_o_code", tidy=tidy)


def _real_stages(x: Inputs) -> DataFrame:
    return x.staged["stages"].filter(~F.col("Stage_Name").isin("-", "?"))


def stage(x: Inputs) -> DataFrame:
    rename = {"Stage_Family": "stage_lvf_family"}
    columns = [c for c in visible(x.staged["stages"]) if c != "Stage_Manufacturer"]
    df = cleaned(_real_stages(x), "stage_", columns, rename)
    df = with_surrogate(df, x.built["engine"], "stage_engine", "e_name", "e_id", "stage_e_id")
    order = [c if c != "stage_engine" else "stage_e_id" for c in df.columns if c != "stage_e_id"]
    numbers = ("stage_length", "stage_diameter", "stage_launch_mass", "stage_dry_mass", "stage_thrust", "stage_duration")
    return typed(df.select(*order), numbers, strict=x.strict)


def stage_manufacturer(x: Inputs) -> DataFrame:
    rows = bridge(
        _real_stages(x),
        {"sm_stage_name": "Stage_Name"},
        "Stage_Manufacturer",
        "sm_manufacturer_o_code",
        prepare=lambda c: F.replace(F.replace(c, F.lit("NCSIST"), F.lit("")), F.lit("ARMT   -"), F.lit("ARMT")),
        tidy=token_map(STAGE_MANUFACTURERS, _undoubted),
    )
    return rows


def launch_vehicle_stage(x: Inputs) -> DataFrame:
    staged = x.staged["lvs"]
    df = cleaned(staged, "lvs_", visible(staged))
    df = with_membership(df, x.built["stage"], "lvs_stage_name", "stage_name", "is_stage")
    routed = route(F.col("lvs_stage_name"), F.col("is_stage"), "lvs_stage_name", "lvs_stage_type")
    names = [c for c in df.columns if c != "is_stage"]
    df = df.select(*[col for c in names for col in (routed if c == "lvs_stage_name" else [F.col(c)])])
    numbers = ("lvs_multiplicity", "lvs_stage_impulse", "lvs_stage_apogee", "lvs_stage_perigee")
    return typed(df, numbers, strict=x.strict)


def _ref(columns: str, table: str, parents: str) -> Reference:
    return Reference(tuple(columns.split()), table, tuple(parents.split()))


def _spec(name: str, build, sort: str, primary: str = "", unique: str = "", refs: tuple = (), needs: str = "") -> TableSpec:
    return TableSpec(
        name, build, tuple(sort.split()), tuple(primary.split()), tuple(unique.split()), refs, tuple(needs.split())
    )


TABLES: dict[str, TableSpec] = {
    spec.name: spec
    for spec in (
        _spec("organization_type", lambda x: organization_type(x.spark), "ot_type", "ot_type"),
        _spec("organization", organization, "o_code", "o_code", refs=(_ref("o_parent_o_code", "organization", "o_code"),)),
        _spec(
            "organization_org_type",
            organization_org_type,
            "oot_o_code",
            "oot_o_code oot_ot_type",
            refs=(_ref("oot_o_code", "organization", "o_code"), _ref("oot_ot_type", "organization_type", "ot_type")),
        ),
        _spec("site", site, "site_code", "site_code"),
        _spec(
            "site_org",
            site_org,
            "so_site_code",
            "so_site_code so_o_code",
            refs=(_ref("so_site_code", "site", "site_code"), _ref("so_o_code", "organization", "o_code")),
        ),
        _spec("platform", platform, "p_code", "p_code"),
        _spec(
            "platform_org",
            platform_org,
            "po_p_code",
            "po_p_code po_o_code",
            refs=(_ref("po_p_code", "platform", "p_code"), _ref("po_o_code", "organization", "o_code")),
        ),
        _spec(
            "launch_point",
            launch_point,
            "lp_site_code lp_code",
            "lp_site_code lp_code",
            refs=(_ref("lp_site_code", "site", "site_code"),),
        ),
        _spec(
            "launch_point_org",
            launch_point_org,
            "lpo_site_code lpo_lp_code",
            "lpo_site_code lpo_lp_code lpo_o_code",
            refs=(
                _ref("lpo_site_code lpo_lp_code", "launch_point", "lp_site_code lp_code"),
                _ref("lpo_o_code", "organization", "o_code"),
            ),
        ),
        _spec("launch_vehicle_family", launch_vehicle_family, "lvf_family", "lvf_family"),
        _spec(
            "launch_vehicle",
            launch_vehicle,
            "lv_name lv_variant",
            unique="lv_name lv_variant",
            refs=(_ref("lv_lvf_family", "launch_vehicle_family", "lvf_family"),),
        ),
        _spec(
            "launch_vehicle_org",
            launch_vehicle_org,
            "lvo_lv_name lvo_lv_variant",
            unique="lvo_lv_name lvo_lv_variant lvo_o_code",
            refs=(
                _ref("lvo_lv_name lvo_lv_variant", "launch_vehicle", "lv_name lv_variant"),
                _ref("lvo_o_code", "organization", "o_code"),
            ),
        ),
        _spec("reference", reference, "r_cite", "r_cite"),
        _spec(
            "launch",
            launch,
            "l_launch_tag",
            "l_launch_tag",
            refs=(
                _ref("l_p_code", "platform", "p_code"),
                _ref(SITE, "site", "site_code"),
                _ref(f"{SITE} {PAD}", "launch_point", "lp_site_code lp_code"),
                _ref(ASCENT_SITE, "site", "site_code"),
                _ref(f"{ASCENT_SITE} {ASCENT_PAD}", "launch_point", "lp_site_code lp_code"),
                _ref("l_lv_name l_lv_variant", "launch_vehicle", "lv_name lv_variant"),
            ),
        ),
        _spec(
            "launch_agency_org",
            launch_agency_org,
            "lao_l_launch_tag lao_o_code",
            "lao_l_launch_tag lao_o_code",
            refs=(_ref("lao_l_launch_tag", "launch", "l_launch_tag"), _ref("lao_o_code", "organization", "o_code")),
        ),
        _spec(
            "launch_payload_org",
            launch_payload_org,
            "lpo_l_launch_tag lpo_o_code",
            "lpo_l_launch_tag lpo_o_code",
            refs=(_ref("lpo_l_launch_tag", "launch", "l_launch_tag"), _ref("lpo_o_code", "organization", "o_code")),
        ),
        _spec(
            "launch_investigator",
            launch_investigator,
            "li_l_launch_tag",
            "li_l_launch_tag li_investigator",
            refs=(_ref("li_l_launch_tag", "launch", "l_launch_tag"),),
        ),
        _spec("world", world, "w_idname", "w_idname"),
        _spec(
            "satellite",
            satellite,
            "s_catalog s_jcat s_satcat",
            refs=(_ref("s_state_o_code", "organization", "o_code"), _ref("s_l_launch_tag", "launch", "l_launch_tag")),
        ),
        _spec(
            "satellite_owner_org",
            satellite_owner_org,
            "soo_s_jcat soo_o_code",
            "soo_s_jcat soo_o_code",
            refs=(_ref("soo_o_code", "organization", "o_code"),),
        ),
        _spec(
            "satellite_manufacturer_org",
            satellite_manufacturer_org,
            "smo_s_jcat smo_o_code",
            "smo_s_jcat smo_o_code",
            refs=(_ref("smo_o_code", "organization", "o_code"),),
        ),
        _spec(
            "payload",
            payload,
            "pay_catalog pay_jcat pay_piece",
            "pay_jcat",
            refs=(_ref("pay_unstate_o_code", "organization", "o_code"),),
        ),
        _spec(
            "payload_category",
            payload_category,
            "pc_pay_jcat pc_category",
            "pc_pay_jcat pc_category",
            refs=(_ref("pc_pay_jcat", "payload", "pay_jcat"),),
        ),
        _spec(
            "payload_discipline",
            payload_discipline,
            "pd_pay_jcat pd_discipline",
            "pd_pay_jcat pd_discipline",
            refs=(_ref("pd_pay_jcat", "payload", "pay_jcat"),),
        ),
        _spec("engine", engine, "e_id", "e_id"),
        _spec(
            "engine_propellant",
            engine_propellant,
            "ep_propellant",
            "ep_e_id ep_propellant ep_fuel_or_oxidizer",
            refs=(_ref("ep_e_id", "engine", "e_id"),),
        ),
        _spec(
            "engine_manufacturer",
            engine_manufacturer,
            "em_e_id em_manufacturer_o_code",
            "em_e_id em_manufacturer_o_code",
            refs=(_ref("em_e_id", "engine", "e_id"), _ref("em_manufacturer_o_code", "organization", "o_code")),
        ),
        _spec(
            "stage",
            stage,
            "stage_name",
            "stage_name",
            refs=(_ref("stage_lvf_family", "launch_vehicle_family", "lvf_family"), _ref("stage_e_id", "engine", "e_id")),
            needs="engine",
        ),
        _spec(
            "stage_manufacturer",
            stage_manufacturer,
            "sm_stage_name sm_manufacturer_o_code",
            "sm_stage_name sm_manufacturer_o_code",
            refs=(_ref("sm_stage_name", "stage", "stage_name"), _ref("sm_manufacturer_o_code", "organization", "o_code")),
        ),
        _spec(
            "launch_vehicle_stage",
            launch_vehicle_stage,
            "lvs_lv_name lvs_lv_variant lvs_stage_no",
            unique="lvs_lv_name lvs_lv_variant lvs_stage_no lvs_stage_name lvs_stage_type",
            refs=(
                _ref("lvs_lv_name lvs_lv_variant", "launch_vehicle", "lv_name lv_variant"),
                _ref("lvs_stage_name", "stage", "stage_name"),
            ),
            needs="stage",
        ),
    )
}
