"""The declared source files: layout, lowest acceptable row count, location."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class SourceSpec:
    """One tab-separated file whose first line is ``#`` plus the column names."""

    name: str
    columns: tuple[str, ...]
    min_rows: int
    folder: str = ""

    @property
    def file_name(self) -> str:
        return f"{self.name}.tsv"

    @property
    def header(self) -> str:
        return "#" + "\t".join(self.columns)

    def path(self, root: str) -> str:
        return "/".join(part for part in (root.rstrip("/"), self.folder, self.file_name) if part)


# Column names per layout, in file order.
LAYOUTS = {
    "launch": "Launch_Tag Launch_JD Launch_Date LV_Type Variant Flight_ID Flight Mission FlightCode Platform"
    " Launch_Site Launch_Pad Ascent_Site Ascent_Pad Apogee Apoflag Range RangeFlag Dest OrbPay Agency LaunchCode"
    " FailCode Group Category LTCite Cite Notes",
    "engines": "Name Manufacturer Family Alt_Name Oxidizer Fuel Mass MFlag Impulse ImpFlag Thrust TFlag Isp IspFlag"
    " Duration DurFlag Chambers Date Usage Group",
    "orgs": "Code UCode StateCode Type Class TStart TStop ShortName Name Location Longitude Latitude Error Parent"
    " ShortEName EName UName",
    "sites": "Site Code UCode Type StateCode TStart TStop ShortName Name Location Longitude Latitude Error Parent"
    " ShortEName EName Group UName",
    "platforms": "Code UCode StateCode Type Class TStart TStop ShortName Name Location Longitude Latitude Error Parent"
    " ShortEName EName VClass VClassID VID Group UName",
    "lp": "Site Code UCode Type StateCode TStart TStop ShortName Name Location Longitude Latitude Error Parent"
    " ShortEName EName UName",
    "family": "Family",
    "lv": "LV_Name LV_Family LV_Manufacturer LV_Variant LV_Alias LV_Min_Stage LV_Max_Stage Length LFlag Diameter DFlag"
    " Launch_Mass MFlag LEO_Capacity GTO_Capacity TO_Thrust Class Apogee Range",
    "refs": "Cite Reference",
    "worlds": "IDT IDName Name AltName Radius PolarRadius Mass SemiMajorAxis Periapsis Ecc Inc Node Peri M Epoch"
    " RotPeriod OrbPeriod Ephemeris WType Primary",
    "spin": "IDT IDName Name Rho IFac PoleRA PoleDec Meridian SpinRate J2 J4 J6 PoleRARate PoleDecRate PoleFunc"
    " SpinFunc InitFunc JFile",
    "object": "JCAT Satcat Launch_Tag Piece Type Name PLName LDate Parent SDate Primary DDate Status Dest Owner State"
    " Manufacturer Bus Motor Mass MassFlag DryMass DryFlag TotMass TotFlag Length LFlag Diameter DFlag Span SpanFlag"
    " Shape ODate Perigee PF Apogee AF Inc IF OpOrbit OQUAL AltNames",
    "payload": "JCAT Piece Name LDate TLast TOp TDate TF Program Plane Att Mvr Class Category Result Control Discipline"
    " UNState UNReg UNPeriod UNPerigee UNApogee UNInc DispEpoch DispPeri DispApo DispInc Comment",
    "usatcat": "JCAT Name",
    "stages": "Stage_Name Stage_Family Stage_Manufacturer Stage_Alt_Name Length Diameter Launch_Mass Dry_Mass Thrust"
    " Duration Engine NEng",
    "lvs": "LV_Name LV_Variant Stage_No Stage_Name Qualifier Dummy Multiplicity Stage_Impulse Stage_Apogee"
    " Stage_Perigee Perigee_Qual",
}

# Folder and lowest row count of each file with a layout of its own.
_SINGLE = {
    "launch": ("launch", 73426),
    "engines": ("tables", 1347),
    "orgs": ("tables", 3270),
    "sites": ("tables", 660),
    "platforms": ("tables", 360),
    "lp": ("tables", 2700),
    "family": ("tables", 615),
    "lv": ("tables", 1660),
    "refs": ("tables", 3050),
    "worlds": ("worlds", 285),
    "spin": ("worlds", 70),
    "usatcat": ("cat", 6070),
    "stages": ("tables", 1430),
    "lvs": ("tables", 4350),
}

# Files that share the object layout and the payload layout.
OBJECT_CATALOGS = {
    "satcat": 50850, "auxcat": 10, "ftocat": 10, "lcat": 10, "rcat": 10, "tmpcat": 10,
    "csocat": 10, "ecat": 10, "deepcat": 10, "hcocat": 10, "lprcat": 10,
}
PAYLOAD_CATALOGS = {
    "psatcat": 20000, "pauxcat": 2000, "pftocat": 500, "ptmpcat": 1, "plcat": 10, "prcat": 100, "pdeepcat": 10,
}


def _columns(layout: str) -> tuple[str, ...]:
    return tuple(LAYOUTS[layout].split())


SOURCES: dict[str, SourceSpec] = {
    **{name: SourceSpec(name, _columns(name), floor, folder) for name, (folder, floor) in _SINGLE.items()},
    **{name: SourceSpec(name, _columns("object"), floor, "cat") for name, floor in OBJECT_CATALOGS.items()},
    **{name: SourceSpec(name, _columns("payload"), floor, "cat") for name, floor in PAYLOAD_CATALOGS.items()},
}


def registry_frame(spark: SparkSession, sources: dict[str, SourceSpec] = SOURCES) -> DataFrame:
    """The registry as rows; one per source, so always small."""
    rows = [(s.name, s.file_name, s.folder, s.min_rows, s.header) for s in sources.values()]
    return spark.createDataFrame(rows, "source string, file_name string, folder string, min_rows long, header string")
