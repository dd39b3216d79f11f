"""Invented catalog files in the declared layouts, a few rows each."""

from __future__ import annotations

import os
from dataclasses import replace

from skyledger.sources.registry import OBJECT_CATALOGS, PAYLOAD_CATALOGS, SOURCES

# Source -> rows; a row names only the cells that matter, the rest are the null mark.
ROWS: dict[str, list[dict[str, str]]] = {
    "orgs": [
        dict(Code="AA", Type="CY/LA", Class="C", TStart="1950", TStop="-", Name=" Alpha ", Longitude="10.5?", Latitude="-3"),
        dict(Code="BB", Type="E", TStart="1961 Apr 12", TStop="2015 Feb ?", Parent="AA", Error="0.1"),
        dict(Code="MOTI", Type="-", TStart="700?", TStop="*", Parent="-"),
        dict(Code="CC", Type="P//O", TStart="927 Jul 12", Parent="MOTI/TMI"),
        dict(Code="CN", Type="CY"), dict(Code="DVNG", Type="LA"), dict(Code="ROKSN", Type="LV"), dict(Code="TIANB", Type="LV"),
        dict(Code="IRGC", Type="E"), dict(Code="SAST", Type="LV"), dict(Code="CLEM", Type="PL"),
    ],
    "sites": [
        dict(Site="GIK-5", Code="x", Type="LS", TStart="1974 Nov  6:", TStop="1990s", Parent="AA/BB?", Longitude="63.3"),
        dict(Site="KASC", Type="LS", TStart="21C", Parent="-"),
        dict(Site="CEL", Type="LS", Parent="AA"),
    ],
    "platforms": [dict(Code="SS-083", Type="SUB", TStart="1958 Q3", Parent="BB", VClass="K", VID="7")],
    "lp": [
        dict(Site="GIK-5", Code="LC1", TStart="1957", TStop="DZK3  -", Parent="PRC/DNVG?"),
        dict(Site="CEL", Code="X", Parent="AA"),
    ],
    "family": [dict(Family="R-7"), dict(Family="R-7"), dict(Family="-")],
    "lv": [
        dict(LV_Name="Soyuz", LV_Family="R-7", LV_Variant="FG", LV_Manufacturer="AA/ROKTSN", LV_Min_Stage="0", Launch_Mass="305?", TO_Thrust="4.1M"),
        dict(LV_Name="Soyuz", LV_Family="R-7", LV_Variant="-", LV_Manufacturer="TIAB"),
        dict(LV_Name="Ghadr 1", LV_Family="PrSM", LV_Variant="-", LV_Manufacturer="NCSIST"),
    ],
    "refs": [dict(Cite="R1", Reference="A \"quoted\" title"), dict(Cite="R2", Reference=" padded ")],
    "launch": [
        dict(Launch_Tag="1960-001", Launch_JD="2436934.5", Launch_Date="1960 Jan   2 0100?", LV_Type="Soyuz", Variant="FG?",
             Platform="SS-088?", Launch_Site="NIIP-5?", Launch_Pad="LC1?", Ascent_Site="DGAEML?", Ascent_Pad="X", Apogee="200?",
             Agency="AA/BB?", LaunchCode="OS", Group="C/X/D", LTCite="R1", Cite="-"),
        dict(Launch_Tag="1960-S1", Launch_Date="1960 Feb", LV_Type="Ghadr-110", Launch_Site="USC", Agency="AA", LaunchCode="AF75",
             Group="AA/CLEM/Smith,Jones?"),
        dict(Launch_Tag="2024-S69", Launch_Date="2024", LaunchCode="SS", Group="Clemson/Lee", Agency="-"),
        dict(Launch_Tag="2023-S29", LaunchCode="SS", Group="RIT/Kim"),
        dict(Launch_Tag="1971-000", LaunchCode="-S", Group="dup/X"),
        dict(Launch_Tag="1969-F13", LaunchCode="OF", Group="H"),
    ],
    "worlds": [
        dict(IDT="S", IDName="Sun", Name="Sun", Mass="1.989E30", Primary="-"),
        dict(IDT="P", IDName="(3)", Name="Earth", Radius="6378", Mass="5.97E24", OrbPeriod="1yr", Epoch="2000 Jan  1  1200", Primary="Sol"),
        dict(IDT="M", IDName="(3/1)", Name="Moon", Mass="7.3E22", OrbPeriod="27.3", Epoch="0 Jun 28  0000:00", Primary="Earth"),
        dict(IDT="A", IDName="(617)", Name="Patroclus", Mass="1360", Primary="-"),
        dict(IDT="A", IDName="(617)", Name="Patroclus", Mass="1400", Primary="-"),
    ],
    "spin": [dict(IDName="(3)", Name="Earth", Rho="5.51", IFac="0.33", J2="1.08E-3", PoleFunc="f1")],
    "satcat": [
        dict(JCAT="S1", Satcat="1", Launch_Tag="1960-001  196", Piece="1960 ALP 1", Type="P  A-X", Name="One", LDate="1960 Jan  2",
             Parent="Earth*", SDate="1960 Jan  0", Primary="Earth", DDate="2023 Mar 19 0048??", Owner="AA/BB?", State="AA",
             Manufacturer="AA/BB??", Mass="83.6?", Apogee="Inf", ODate="2021 Fen 14", Perigee="200", AltNames="Uno"),
        dict(JCAT="S2", Launch_Tag="-          UNK", Type="R", Parent="S1  port2", Owner="NROC/NROC", State="-", Manufacturer="-",
             SDate="2002 Jan 16 0705s", Apogee="42000?"),
    ],
    "deepcat": [dict(JCAT="D1", Type="P", Parent="67P/", SDate="2000 Nov  5  2000?", Owner="AA")],
    "psatcat": [
        dict(JCAT="S1", Piece="1960 ALP 1", Name="One", LDate="1960 Jan  2", TLast="*", TOp="1961?", TDate="* E", Mvr="m",
             Category="COM*/NAV?", Discipline="AS*/EO?", UNState="[AA]*", UNPeriod="90.1", DispEpoch="1970 Jun  1.5"),
        dict(JCAT="S2", LDate="22 Feb 27", TDate="2022  Mar 27?", Category="-", UNState="AA"),
    ],
    "plcat": [dict(JCAT="L1", UNState="-", Category="SCI")],
    "usatcat": [dict(JCAT="S1", Name="Один"), dict(JCAT="S1", Name="Один")],
    "engines": [
        dict(Name="RD-107", Manufacturer="Zulfiqar/AA?", Oxidizer="LOX?", Fuel="Kero/AlTP-H-3062M", Mass="1250", Thrust="1.0M", Date="1957 May 15"),
        dict(Name="JX", Manufacturer="-", Oxidizer="N2O4", Fuel="JPX (JP-4/UDMH)"),
        dict(Name="MX", Manufacturer="BB", Oxidizer="-", Fuel="MMH/"),
    ],
    "stages": [
        dict(Stage_Name="Blok A", Stage_Family="R-7", Stage_Manufacturer="SALT/ARMT   -", Length="28", Engine="RD-107", NEng="4"),
        dict(Stage_Name="Blok B", Stage_Family="R-7", Stage_Manufacturer="NCSIST/AA", Engine="-"),
        dict(Stage_Name="?", Stage_Manufacturer="AA"),
    ],
    "lvs": [
        dict(LV_Name="Soyuz", LV_Variant="FG", Stage_No="1", Stage_Name="Blok A", Multiplicity="4", Stage_Impulse="2.5?"),
        dict(LV_Name="Soyuz", LV_Variant="FG", Stage_No="F", Stage_Name="Fairing", Dummy="D"),
    ],
}

# Codes that the rows above refer to and that need a row of their own.
ROWS["orgs"] += [dict(Code=c, Type="O") for c in ("ARMT", "NROC", "OKB52", "TMI")]
ROWS["lv"] += [dict(LV_Name="Minotaur C", LV_Variant="-", LV_Family="Spectrum", LV_Manufacturer="-")]
ROWS["worlds"] += [dict(IDT="C", IDName="67P", Name="Churyumov-Gerasimenko", Primary="-")]


def small_registry():
    """All sources, with floors the invented rows can meet."""
    return {name: replace(spec, min_rows=len(ROWS.get(name, []))) for name, spec in SOURCES.items()}


def write_catalogs(root: str, rows: dict[str, list[dict[str, str]]] | None = None) -> str:
    """Write every declared file below a folder; comment lines follow the header."""
    rows = ROWS if rows is None else rows
    for name, spec in SOURCES.items():
        path = spec.path(root)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w", encoding="utf-8") as f:
            f.write(spec.header + "\n# Updated today\n")
            for row in rows.get(name, []):
                f.write("\t".join(row.get(c, "-") for c in spec.columns) + "\n")
    return root


assert set(ROWS) <= set(SOURCES) and OBJECT_CATALOGS and PAYLOAD_CATALOGS
