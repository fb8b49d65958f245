"""Measurement families: industrial time series, medical imaging, clinical and subsurface records."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.clinical import clinical_extract
from tidemark.operators import aggregate as Ag
from tidemark.operators import explode as X
from tidemark.operators import incremental as I
from tidemark.operators import joins as J
from tidemark.operators import reshape as R
from tidemark.operators import scan as Sc

# ---- industrial time series -----------------------------------------------


def recorded_points(df: DataFrame, raw: str = "raw") -> DataFrame:
    """Recorded values, one row per tag and time even if a range was read twice."""
    return I.dedupe_points(R.recorded_values(df, raw), "tag_webid", "timestamp")


def event_frame_elements(frames: DataFrame, refs: DataFrame) -> DataFrame:
    return J.referenced_elements(frames, refs)


# ---- medical imaging ------------------------------------------------------

# Image tags, their names and forms.
STUDY_TAGS = {
    "0020000D": ("study_instance_uid", "text"),
    "00080020": ("study_date", "text"),
    "00080030": ("study_time", "text"),
    "00080050": ("accession_number", "text"),
    "00100010": ("patient_name", "name"),
    "00100020": ("patient_id", "text"),
    "00081030": ("study_description", "text"),
    "00080061": ("modalities_in_study", "list"),
    "00201206": ("number_of_study_related_series", "long"),
    "00201208": ("number_of_study_related_instances", "long"),
}
SERIES_TAGS = {
    "0020000E": ("series_instance_uid", "text"),
    "0020000D": ("study_instance_uid", "text"),
    "00080020": ("study_date", "text"),
    "00200011": ("series_number", "long"),
    "0008103E": ("series_description", "text"),
    "00080060": ("modality", "text"),
    "00180015": ("body_part_examined", "text"),
    "00080021": ("series_date", "text"),
}
INSTANCE_TAGS = {
    "00080018": ("sop_instance_uid", "text"),
    "0020000E": ("series_instance_uid", "text"),
    "0020000D": ("study_instance_uid", "text"),
    "00080016": ("sop_class_uid", "text"),
    "00200013": ("instance_number", "long"),
    "00080020": ("study_date", "text"),
    "00080023": ("content_date", "text"),
    "00080033": ("content_time", "text"),
}


def studies(df: DataFrame, raw: str = "raw") -> DataFrame:
    return R.tag_extract(df, raw, STUDY_TAGS)


def series(df: DataFrame, parents: DataFrame, raw: str = "raw") -> DataFrame:
    """Series rows; a missing study date comes from the study."""
    rows = R.tag_extract(df, raw, SERIES_TAGS)
    return J.inherit(rows, parents, "study_instance_uid", "study_instance_uid", {"study_date": "study_date"})


def instances(df: DataFrame, parents: DataFrame, lookup: DataFrame | None = None, raw: str = "raw") -> DataFrame:
    """Instance rows with the study date of their study and, if given, their full tag set.

    ``lookup(sop_instance_uid, metadata)`` holds the tag sets as text.
    """
    rows = R.tag_extract(df, raw, INSTANCE_TAGS)
    out = J.inherit(rows, parents, "study_instance_uid", "study_instance_uid", {"study_date": "study_date"})
    if lookup is None:
        return out.withColumn("metadata", F.lit(None).cast("string"))
    side = lookup.select("sop_instance_uid", "metadata")
    return out.join(side, "sop_instance_uid", "left")


def study_bins(rows: DataFrame, bins: int) -> DataFrame:
    """Studies spread over bins by their number of series."""
    weighted = rows.withColumn("_w", F.coalesce("number_of_study_related_series", F.lit(1)))
    keyed = weighted.withColumn("_k", F.xxhash64("study_instance_uid"))
    return Ag.balance_partitions(keyed, "_k", "_w", bins).drop("_w", "_k")


# ---- clinical records -----------------------------------------------------


def clinical_records(pages: DataFrame, resource: str, since: Any = None, profile: str = "uk_core", raw: str = "raw") -> DataFrame:
    """Bundle pages to typed records newer than ``since``; undated records are kept."""
    entries = X.bundle_entries(pages.select(raw), raw)
    rows = clinical_extract(entries, "resource", resource, profile)
    if since is None:
        return rows
    return rows.where(F.col("lastUpdated").isNull() | (F.col("lastUpdated") > F.lit(since).cast("timestamp")))


# ---- subsurface records ---------------------------------------------------

# Columns of every record.
SUBSURFACE_FIELDS = {
    "id": ("id", "text"),
    "kind": ("kind", "text"),
    "version": ("version", "long"),
    "createTime": ("createTime", "text"),
    "createUser": ("createUser", "text"),
    "modifyTime": ("modifyTime|createTime", "text"),
    "modifyUser": ("modifyUser", "text"),
    "acl_owners": ("acl.owners", "list"),
    "acl_viewers": ("acl.viewers", "list"),
    "legal_legaltags": ("legal.legaltags", "list"),
    "legal_status": ("legal.status", "text"),
    "legal_otherRelevantDataCountries": ("legal.otherRelevantDataCountries", "list"),
    "tags_json": ("tags", "json"),
    "meta_json": ("meta", "json"),
    "data_json": ("data", "json"),
}


# Columns of each kind, their path in a record and how it is read.
SUBSURFACE_KINDS = {
    "master-data--Wellbore": {
        "FacilityID": ("data.FacilityID", "text"),
        "FacilityName": ("data.FacilityName", "text"),
        "FacilityTypeID": ("data.FacilityTypeID", "text"),
        "WellID": ("data.WellID", "text"),
        "KickOffWellboreID": ("data.KickOffWellboreID", "text"),
        "StatusSummary": ("data.StatusSummary", "text"),
        "TargetFormation": ("data.TargetFormation", "text"),
        "FacilityNameAliases_json": ("data.FacilityNameAliases", "json"),
        "FacilityOperators_json": ("data.FacilityOperators", "json"),
        "VerticalMeasurements_json": ("data.VerticalMeasurements", "json"),
        "SpatialLocation_json": ("data.SpatialLocation", "json"),
        "GeoContexts_json": ("data.GeoContexts", "json"),
        "DrillingReasons_json": ("data.DrillingReasons", "json"),
        "InitialCompletion_json": ("data.InitialCompletion", "json"),
        "ExtensionProperties_json": ("data.ExtensionProperties", "json"),
    },
    "master-data--Reservoir": {
        "ReservoirID": ("data.ReservoirID", "text"),
        "ReservoirName": ("data.ReservoirName", "text"),
        "ReservoirType": ("data.ReservoirType", "text"),
        "ReservoirDescription": ("data.ReservoirDescription", "text"),
        "FieldID": ("data.FieldID", "text"),
        "BasinID": ("data.BasinID", "text"),
        "FormationID": ("data.FormationID", "text"),
        "FluidTypeID": ("data.FluidTypeID", "text"),
        "DepthTopMD": ("data.DepthTopMD", "double"),
        "DepthBaseMD": ("data.DepthBaseMD", "double"),
        "DepthTopTVD": ("data.DepthTopTVD", "double"),
        "DepthBaseTVD": ("data.DepthBaseTVD", "double"),
        "GrossThickness": ("data.GrossThickness", "double"),
        "NetPayThickness": ("data.NetPayThickness", "double"),
        "PorosityAverage": ("data.PorosityAverage", "double"),
        "WaterSaturationAverage": ("data.WaterSaturationAverage", "double"),
        "PermeabilityHorizontal": ("data.PermeabilityHorizontal", "double"),
        "PermeabilityVertical": ("data.PermeabilityVertical", "double"),
        "InitialReservoirPressure": ("data.InitialReservoirPressure", "double"),
        "ReservoirTemperature": ("data.ReservoirTemperature", "double"),
        "GeoContexts_json": ("data.GeoContexts", "json"),
        "NameAliases_json": ("data.NameAliases", "json"),
        "ExtensionProperties_json": ("data.ExtensionProperties", "json"),
    },
    "master-data--Sample": {
        "SampleAcquisitionJobID": ("data.SampleAcquisition.SampleAcquisitionJobID", "text"),
        "SampleAcquisitionTypeID": ("data.SampleAcquisition.SampleAcquisitionTypeID", "text"),
        "SampleAcquisitionContainerID": ("data.SampleAcquisition.SampleAcquisitionContainerID", "text"),
        "AcquisitionStartDate": ("data.SampleAcquisition.AcquisitionStartDate", "text"),
        "AcquisitionEndDate": ("data.SampleAcquisition.AcquisitionEndDate", "text"),
        "CollectionServiceCompanyID": ("data.SampleAcquisition.CollectionServiceCompanyID", "text"),
        "HandlingServiceCompanyID": ("data.SampleAcquisition.HandlingServiceCompanyID", "text"),
        "WellboreID": ("data.SampleAcquisition.SampleAcquisitionDetail.WellboreID", "text"),
        "ToolKind": ("data.SampleAcquisition.SampleAcquisitionDetail.ToolKind", "text"),
        "RunNumber": ("data.SampleAcquisition.SampleAcquisitionDetail.RunNumber", "text"),
        "TopDepth": ("data.SampleAcquisition.SampleAcquisitionDetail.TopDepth", "double"),
        "BaseDepth": ("data.SampleAcquisition.SampleAcquisitionDetail.BaseDepth", "double"),
        "FormationPressure": ("data.SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Pressure", "double"),
        "FormationTemperature": ("data.SampleAcquisition.SampleAcquisitionDetail.FormationCondition.Temperature", "double"),
        "SampleAcquisition_json": ("data.SampleAcquisition", "json"),
        "ExtensionProperties_json": ("data.ExtensionProperties", "json"),
    },
}


def subsurface_records(df: DataFrame, kind: str | None = None, raw: str = "raw") -> DataFrame:
    """Flat records; with ``kind`` the columns of that kind are added."""
    if kind is None:
        return R.flatten_envelope(df, raw, SUBSURFACE_FIELDS)
    return R.flatten_envelope(df, raw, SUBSURFACE_FIELDS, {kind: SUBSURFACE_KINDS[kind]})


def subsurface_windows(df: DataFrame, bounds: DataFrame, days: int, lookback_minutes: int) -> DataFrame:
    """Records by planned ``modifyTime`` window."""
    windows = Sc.plan_windows(bounds, "since", "until", days, lookback_minutes)
    return Sc.scan_partitioned(df, "modifyTime", windows)
