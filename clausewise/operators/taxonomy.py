"""Taxonomies, their reports and the drill-down."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.functions.text import html_escape, label_key

# Coarse keys with their titles.
COARSE = [
    ("overpriced_poor_value", "Overpriced / Poor Value for Money"),
    ("animal_captivity_welfare", "Animal Captivity & Welfare"),
    ("tides_weather_water", "Tides, Weather & Water Conditions"),
    ("hidden_charges_payments_tipping", "Hidden Charges, Payments & Tipping"),
    ("safety_health_hazards", "Safety & Health Hazards"),
    ("overcrowding", "Overcrowding"),
    ("staff_behaviour_customer_service", "Staff Behaviour & Customer Service"),
    ("maintenance_disrepair_heritage_decay", "Maintenance, Disrepair & Heritage Decay"),
    ("cleanliness_litter_pollution", "Cleanliness, Litter & Pollution"),
    ("access_location_infrastructure", "Access, Location & Infrastructure"),
    ("aggressive_vendors_touts_harassment", "Aggressive Vendors, Touts & Harassment"),
    ("tour_organisation_duration_logistics", "Tour Organisation, Duration & Logistics"),
    ("scams_fraud_misleading_claims", "Scams, Fraud & Misleading Claims"),
    ("tourist_wildlife_interaction", "Tourist–Wildlife Interaction"),
    ("limited_content_underwhelming", "Limited Content / Underwhelming Experience"),
    ("closures_restricted_access", "Closures & Restricted Access"),
    ("guide_quality_knowledge", "Guide Quality & Knowledge"),
    ("coral_ecosystem_damage_overcommercialisation", "Coral, Ecosystem Damage & Over-commercialisation"),
    ("noise_atmosphere", "Noise & Atmosphere"),
    ("cultural_sensitivity_authenticity", "Cultural Sensitivity & Authenticity"),
    ("other", "Other"),
]
# Fine subcategories: group key, group title, key, title.
FINE = [
    ("safety_and_security", "Safety & Security", "unsafe_activity_or_operation", "Unsafe activity or operation"),
    ("safety_and_security", "Safety & Security", "water_boating_safety", "Water/boating safety"),
    ("safety_and_security", "Safety & Security", "theft", "Theft"),
    ("safety_and_security", "Safety & Security", "scams_fraud", "Scams/fraud"),
    ("safety_and_security", "Safety & Security", "harassment", "Harassment"),
    ("safety_and_security", "Safety & Security", "inadequate_safety_measures", "Inadequate safety measures"),
    ("safety_and_security", "Safety & Security", "emergency_response", "Emergency response"),
    ("safety_and_security", "Safety & Security", "personal_security", "Personal security"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "litter_garbage", "Litter/garbage"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "beach_cleanliness", "Beach cleanliness"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "marine_litter", "Marine litter"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "dirty_premises", "Dirty premises"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "toilet_cleanliness", "Toilet cleanliness"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "poor_sanitation", "Poor sanitation"),
    ("cleanliness_and_sanitation", "Cleanliness & Sanitation", "waste_collection_disposal", "Waste collection/disposal"),
    ("environment_and_conservation", "Environment & Conservation", "coral_reef_damage", "Coral/reef damage"),
    ("environment_and_conservation", "Environment & Conservation", "habitat_degradation", "Habitat degradation"),
    ("environment_and_conservation", "Environment & Conservation", "pollution", "Pollution"),
    ("environment_and_conservation", "Environment & Conservation", "environmental_damage", "Environmental damage"),
    ("environment_and_conservation", "Environment & Conservation", "conservation_concerns", "Conservation concerns"),
    ("environment_and_conservation", "Environment & Conservation", "unsustainable_tourism_practices", "Unsustainable tourism practices"),
    ("wildlife_and_animal_welfare", "Wildlife & Animal Welfare", "animal_welfare", "Animal welfare"),
    ("wildlife_and_animal_welfare", "Wildlife & Animal Welfare", "wildlife_harassment", "Wildlife harassment"),
    ("wildlife_and_animal_welfare", "Wildlife & Animal Welfare", "inappropriate_animal_interaction", "Inappropriate animal interaction"),
    ("wildlife_and_animal_welfare", "Wildlife & Animal Welfare", "poor_animal_conditions", "Poor animal conditions"),
    ("wildlife_and_animal_welfare", "Wildlife & Animal Welfare", "disturbance_of_marine_life", "Disturbance of marine life"),
    ("wildlife_and_animal_welfare", "Wildlife & Animal Welfare", "wildlife_management_concerns", "Wildlife management concerns"),
    ("overcrowding_and_visitor_management", "Overcrowding & Visitor Management", "attraction_overcrowding", "Attraction overcrowding"),
    ("overcrowding_and_visitor_management", "Overcrowding & Visitor Management", "beach_overcrowding", "Beach overcrowding"),
    ("overcrowding_and_visitor_management", "Overcrowding & Visitor Management", "excessive_boats_vehicles", "Excessive boats/vehicles"),
    ("overcrowding_and_visitor_management", "Overcrowding & Visitor Management", "congestion", "Congestion"),
    ("overcrowding_and_visitor_management", "Overcrowding & Visitor Management", "uncontrolled_visitor_numbers", "Uncontrolled visitor numbers"),
    ("overcrowding_and_visitor_management", "Overcrowding & Visitor Management", "queue_crowd_management", "Queue/crowd management"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "overpricing", "Overpricing"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "poor_value_for_money", "Poor value for money"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "tourist_specific_pricing", "Tourist-specific pricing"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "hidden_unclear_charges", "Hidden/unclear charges"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "payment_disputes", "Payment disputes"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "aggressive_selling", "Aggressive selling"),
    ("pricing_and_commercial_practices", "Pricing & Commercial Practices", "misleading_commercial_claims", "Misleading commercial claims"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "rude_unprofessional_behaviour", "Rude/unprofessional behaviour"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "poor_guide_quality", "Poor guide quality"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "poor_customer_service", "Poor customer service"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "poor_communication", "Poor communication"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "unreliable_service", "Unreliable service"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "delays", "Delays"),
    ("service_quality_and_professionalism", "Service Quality & Professionalism", "poor_tour_service_execution", "Poor tour/service execution"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "poor_roads_access", "Poor roads/access"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "transport_availability", "Transport availability"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "parking", "Parking"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "toilets_changing_facilities", "Toilets/changing facilities"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "signage", "Signage"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "physical_accessibility", "Physical accessibility"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "poorly_maintained_infrastructure", "Poorly maintained infrastructure"),
    ("infrastructure_and_accessibility", "Infrastructure & Accessibility", "lack_of_basic_facilities", "Lack of basic facilities"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "experience_below_expectations", "Experience below expectations"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "attraction_poorly_maintained", "Attraction poorly maintained"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "limited_activities", "Limited activities"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "poor_organisation", "Poor organisation"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "insufficient_interpretation_information", "Insufficient interpretation/information"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "closure_unavailability", "Closure/unavailability"),
    ("attraction_and_experience_quality", "Attraction & Experience Quality", "experience_not_matching_description", "Experience not matching description"),
    ("beach_and_water_conditions", "Beach & Water Conditions", "water_quality", "Water quality"),
    ("beach_and_water_conditions", "Beach & Water Conditions", "seaweed", "Seaweed"),
    ("beach_and_water_conditions", "Beach & Water Conditions", "beach_condition", "Beach condition"),
    ("beach_and_water_conditions", "Beach & Water Conditions", "swimming_conditions", "Swimming conditions"),
    ("beach_and_water_conditions", "Beach & Water Conditions", "snorkelling_diving_conditions", "Snorkelling/diving conditions"),
    ("beach_and_water_conditions", "Beach & Water Conditions", "seasonal_natural_conditions", "Seasonal/natural conditions"),
    ("visitor_information_and_booking", "Visitor Information & Booking", "incorrect_online_information", "Incorrect online information"),
    ("visitor_information_and_booking", "Visitor Information & Booking", "incorrect_opening_hours", "Incorrect opening hours"),
    ("visitor_information_and_booking", "Visitor Information & Booking", "location_map_issues", "Location/map issues"),
    ("visitor_information_and_booking", "Visitor Information & Booking", "booking_problems", "Booking problems"),
    ("visitor_information_and_booking", "Visitor Information & Booking", "reservation_issues", "Reservation issues"),
    ("visitor_information_and_booking", "Visitor Information & Booking", "insufficient_visitor_information", "Insufficient visitor information"),
]


def coarse_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(COARSE)], "ord int, category string, category_label string")


def fine_rows(compat: bool = True) -> list[tuple]:
    """(ord, group_id, group_label, subcategory_key, subcategory_label); the residual is last."""
    residual = ("residual", "residual", "other", "Unknown: other") if compat else (
        "residual", "Other", "other", "Does not fit any specific subcategory")
    return [(i, *r) for i, r in enumerate([*FINE, residual])]


def fine_dim(spark: SparkSession, compat: bool = True) -> DataFrame:
    return spark.createDataFrame(
        fine_rows(compat), "ord int, group_id string, group_label string, subcategory_key string, subcategory_label string")


def coarse_category(reply, spark_titles: bool = True, fix_dash: bool = False):
    """Key of a reply that echoes a key or a title; else 'other'. Titles are compared with their
    dash made plain, the reply only with ``fix_dash``."""
    said = label_key(F.trim(reply)) if fix_dash else F.lower(F.trim(reply))
    out = F.lit("other")
    for key, title in reversed(COARSE):
        out = F.when(said.isin(key, title.lower().replace("–", "-")), key).otherwise(out)
    return out


def valid_key(column, keys: list[str]):
    return F.when(column.isin(keys), column).otherwise("other")


def category_summary(classified: DataFrame, key: str, order: str) -> DataFrame:
    """(key, n, rank): categories by falling count, then by their first row in ``order``."""
    counts = classified.groupBy(key).agg(F.count("*").alias("n"), F.min(order).alias("__o"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "__o"))).drop("__o")  # a row a category


def report(classified: DataFrame, dim: DataFrame) -> DataFrame:
    """cluster_id, category, block_name, size -> one row a category in taxonomy order, blocks by id."""
    block = F.struct("cluster_id", "block_name", "size")
    grouped = classified.groupBy("category").agg(F.count("*").cast("int").alias("block_count"), F.array_sort(F.collect_list(block)).alias("blocks"))
    return grouped.join(dim, "category").select("ord", "category", "category_label", "block_count", "blocks").orderBy("ord").drop("ord")


def fine_report(classified: DataFrame, dim: DataFrame) -> DataFrame:
    """cluster_id, subcategory_key, block_name, size -> one row a group; unknown keys are residual."""
    known = classified.join(dim, "subcategory_key", "left")
    rows = known.select(
        F.coalesce("ord", F.lit(9999)).alias("ord"), F.coalesce("group_id", F.lit("residual")).alias("group_id"),
        F.coalesce("group_label", F.lit("residual")).alias("group_label"), "cluster_id", "subcategory_key",
        F.coalesce("subcategory_label", F.concat(F.lit("Unknown: "), "subcategory_key")).alias("subcategory_label"), "block_name", "size")
    block = F.struct("cluster_id", "subcategory_key", "subcategory_label", "block_name", "size")
    return rows.groupBy("group_id", "group_label").agg(
        F.min("ord").alias("ord"), F.count("*").cast("int").alias("block_count"), F.array_sort(F.collect_list(block)).alias("blocks")
    ).orderBy("ord").drop("ord")


def rollup(blocks: DataFrame) -> DataFrame:
    """group, subcategory -> totals at both levels (subcategory null: the group; both null: all)."""
    return blocks.rollup("grp", "sub").agg(F.count("*").alias("block_count"), F.sum("size").cast("long").alias("clause_total"))


def drill_down(blocks: DataFrame) -> DataFrame:
    """grp, sub, sub_label, cluster_id, block_name, size -> nested groups in display order."""
    block = F.struct((-F.col("size")).alias("s"), "cluster_id", "block_name", "size")
    subs = blocks.groupBy("grp", "sub", "sub_label").agg(
        F.count("*").alias("block_count"), F.sum("size").cast("long").alias("clause_total"),
        F.transform(F.array_sort(F.collect_list(block)), lambda b: F.struct(b["cluster_id"], b["block_name"], b["size"])).alias("blocks"))
    sub = F.struct((-F.col("clause_total")).alias("s"), html_escape(F.col("sub_label")).alias("label"), "sub", "block_count", "clause_total", "blocks")
    return subs.groupBy("grp").agg(
        F.sum("block_count").alias("block_count"), F.sum("clause_total").alias("clause_total"), F.array_sort(F.collect_list(sub)).alias("subcategories")
    ).orderBy(F.desc("clause_total"), F.desc("block_count"), "grp")


def not_cached(blocks: DataFrame, cache: DataFrame, key: str = "cluster_id") -> DataFrame:
    return blocks.join(cache.select(key), key, "left_anti")
