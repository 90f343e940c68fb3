"""The datasets the warehouse knows.

Fixed values: key columns, record ids and column types of the published tables. Columns that are
not listed are text (upper-cased). 'a>b' renames landed column a to b.
"""

from __future__ import annotations

from civiclake.functions.geometry import boundary_from_geojson, point
from civiclake.plans.spec import DatasetSpec, column_specs

REGISTRY: dict[str, DatasetSpec] = {}


def _add(name: str, key: str, record_id: str | None = None, **options) -> None:
    """Options: ``derived``, ``excluded``, ``patterns``, ``always_keyed``; all others are column
    groups by rule."""
    spec_options = {
        k: options.pop(k)
        for k in ("derived", "excluded", "patterns", "always_keyed", "srid")
        if k in options
    }
    keys = tuple(key.split())
    REGISTRY[name] = DatasetSpec(
        name, keys, record_id or keys[0], column_specs(**options), **spec_options
    )


# Census estimates: every '<table>_<line>e' and '..m' column is a number, the annotations are text.
ESTIMATES = {r"b\d{5}[a-z]?_\d{3}[em]": "bigint", "dataset_id": "bigint"}
for _name in (
    "cc_hh_earnings_in_last_12mo_by_tract",
    "cc_hh_income_in_last_12mo_by_tract",
    "cc_hh_internet_access_by_age_by_tract",
    "cc_housing_occupancy_by_tract_acs5",
    "cc_housing_tenure_single_race_by_tract_acs5",
    "cc_housing_units_by_tract",
    "cc_mortgage_status_by_tract_acs5",
    "cc_transportation_to_work_by_occ_by_tract",
    "gross_rent_by_cook_county_il_tract",
):
    _add(_name, "geo_id", patterns=ESTIMATES)
_add(
    "cc_planning_db_housing_and_demos_by_bg",
    "gidbg",
    double="avg_tot_prns_in_hhd_cen_2010 avg_tot_prns_in_hhd_acs_14_18 median_age_acs_14_18",
    money="avg_agg_hh_inc_acs_14_18 aggregate_hh_inc_acs_14_18 med_hhd_inc_bg_acs_14_18",
    plain_text="dataset_base_url",
    patterns={r".*_(cen_2010|acs_14_18)": "bigint", "dataset_id": "bigint"},
)

# City tables
_add(
    "chicago_affordable_rental_housing",
    "address management_company units property_type",
    "housing_development_id",
    char__5="zip_code",
    smallint="community_area_number units",
    double="x_coordinate y_coordinate latitude longitude",
    geometry="geometry",
)
_add(
    "chicago_bike_paths",
    "st_name f_street t_street br_ow_dir",
    "bike_route_segment_id",
    double="mi_ctrline",
    geometry__MULTILINESTRING="geometry",
)
_add(
    "chicago_building_violations",
    "id",
    bigint="id",
    date="violation_date violation_status_date",
    zoned="violation_last_modified_date",
    double="longitude latitude",
    geometry__POINT="geometry",
)


def _parts():
    return {"geometry_parts": lambda: boundary_from_geojson("geometry")}


_add(
    "chicago_city_boundary",
    "objectid",
    smallint="objectid",
    double="shape_area shape_len",
    geometry__MULTIPOLYGON="geometry",
    derived=_parts(),
)
_add(
    "chicago_community_area_boundaries",
    "area_numbe",
    "community_area_id",
    always_keyed=True,
    smallint="area_numbe",
    double="shape_len shape_area",
    geometry__MULTIPOLYGON="geometry",
    derived=_parts(),
)
_add(
    "chicago_crimes",
    "id",
    bigint="id x_coordinate y_coordinate",
    zoned="date updated_on",
    boolean="domestic arrest",
    no_leading_zero="district",
    smallint="ward",
    double="latitude longitude",
    geometry_or_null__POINT="geometry",
)
_add(
    "chicago_cta_bus_stops",
    "systemstop",
    before_dot_smallint="systemstop",
    text="public_nam>public_name",
    geometry__POINT="geometry",
)
_add("chicago_cta_train_lines", "description", geometry__MULTILINESTRING="geometry")
_add(
    "chicago_cta_train_stations",
    "stop_id",
    char__1="direction_id",
    int="map_id",
    boolean="red>red_line o>orange_line pnk>pink_line y>yellow_line g>green_line blue>blue_line "
    "p>purple_line pexp>purple_express brn>brown_line ada",
    geometry__POINT="geometry",
)
_add(
    "chicago_divvy_stations",
    "id",
    double="latitude longitude",
    bigint="docks_in_service total_docks",
    geometry__POINT="geometry",
)
_add(
    "chicago_dph_environmental_enforcements",
    "ticket_no case_id respondent comment address code_violation",
    "violation_notice_id",
    date="violation_date",
    money="fine_amount",
    int="street_number street_number_to",
    double="latitude longitude",
    geometry__POINT="geometry",
)
_add(
    "chicago_food_inspections",
    "inspection_id",
    int="inspection_id license_>license_id",
    date="inspection_date",
    letters_only="city",
    char__5="zip",
    char__2="state",
    double="latitude longitude",
    geometry="geometry",
)
_add(
    "chicago_homicide_and_shooting_victimizations",
    "unique_id",
    zoned="date updated",
    smallint="day_of_week ward",
    char__5="zip_code",
    padded_char__4="beat",
    padded_char__2="district hour month",
    char__1="area",
    varchar__3="state_house_district incident_fbi_cd victimization_fbi_cd",
    varchar__2="state_senate_district",
    varchar__4="incident_iucr_cd victimization_iucr_cd",
    boolean="gunshot_injury_i",
    double="latitude longitude",
    geometry="geometry",
)
_add(
    "chicago_murals",
    "mural_registration_id",
    int="mural_registration_id",
    double="latitude longitude",
    geometry__POINT="geometry",
)
_add(
    "chicago_parks",
    "park_no",
    numeric_bigint="park_no gisobjid",
    numeric_smallint="ward",
    smallint="wheelchr_a>wheelchr_accs archery_ra>archery_ranges artificial>artificial_turf "
    "baseball_s>baseball_fields baseball_j>baseball_jr_fields baseball_b>batting_cages basketball "
    "basketba_1 bocce_cour>bocce_courts bowling_gr boxing_cen>boxing_gym game_table>chess_tables "
    "climbing_w>climbing_walls cricket_fi>cricket_fields croquet fitness_co>fitness_courses "
    "fitness_ce>fitness_center football_s>football_fields golf_cours>golf_courses "
    "golf_putti>golf_putting golf_drivi>golf_driving minigolf gymnasium "
    "gymnastic_>gymnastic_centers handball_r handball_i horseshoe_>horseshoe_courts iceskating "
    "mountain_b>mountain_biking playground playgrou_1 sport_roll>roller_court "
    "shuffleboa>shuffleboard skate_park sled_hill tennis_cou>tennis_courts track volleyball "
    "volleyba_1 beach boat_launc>boat_launches boat_lau_1 boat_slips casting_pi>fishing "
    "rowing_clu>rowing_club harbor modelyacht>modelyacht_basin pool_indoo>pool_indoor "
    "pool_outdo>pool_outdoor spray_feat water_slid water_play nature_bir>nature_birds conservato "
    "lagoon garden nature_cen wetland_ar>wetland_area zoo band_shell cultural_c>cultural_center "
    "gallery modeltrain carousel community_>community_center dog_friend senior_cen",
    bigint="objectid_1",
    numeric="shape_area perimeter shape_leng acres",
    geometry__MULTIPOLYGON="geometry",
)
_add(
    "chicago_police_beat_boundaries",
    "beat_num",
    char__1="beat sector",
    char__2="district",
    geometry__MULTIPOLYGON="geometry",
    derived=_parts(),
    excluded={"beat_num": ("3100",)},
)
_add(
    "chicago_police_district_boundaries",
    "dist_num",
    padded_char__2="dist_num",
    geometry__MULTIPOLYGON="geometry",
    derived=_parts(),
    excluded={"dist_num": ("31",)},
)
_add(
    "chicago_police_stations",
    "district_name",
    police_district="district",
    double="x_coordinate y_coordinate latitude longitude",
    geometry__POINT="geometry",
)
_add(
    "chicago_potholes_patched",
    "address request_date completion_date",
    "pothole_repair_id",
    zoned="request_date completion_date",
    smallint="number_of_potholes_filled_on_block",
    double="latitude longitude",
    geometry="geometry",
)
_add(
    "chicago_relocated_vehicles",
    "service_request_number",
    zoned="relocated_date",
    double="relocated_from_longitude relocated_from_latitude relocated_from_x_coordinate "
    "relocated_from_y_coordinate",
    varchar__20="make",
    char__2="state",
    varchar__12="color",
    geometry__POINT="geometry",
)
_add(
    "chicago_shotspotter_alerts",
    "unique_id",
    zoned="date",
    smallint="day_of_week rounds ward",
    char__5="zip_code",
    padded_char__4="beat",
    padded_char__2="district hour month",
    char__1="area",
    varchar__3="illinois_house_district",
    varchar__2="illinois_senate_district",
    double="latitude longitude",
    geometry__POINT="geometry",
)
_add(
    "chicago_sidewalk_cafe_permits",
    "permit_number",
    int="account_number",
    smallint="site_number ward",
    date="issued_date expiration_date payment_date",
    padded_char__2="police_district",
    double="longitude latitude",
    geometry_or_null__POINT="geometry",
)
_add(
    "chicago_speed_camera_violations",
    "camera_id violation_date",
    "camera_violations_id",
    date="violation_date",
    bigint="violations",
    double="x_coordinate y_coordinate longitude latitude",
    geometry__POINT="geometry",
)
_add(
    "chicago_street_center_lines",
    "objectid",
    bigint="objectid",
    text="street_nam>street_name street_typ>street_type suf_dir>suffix_dir l_parity>left_parity "
    "l_zip>left_zip l_fips>left_fips l_censusbl>left_censusbl r_parity>right_parity "
    "r_zip>right_zip r_fips>right_fips r_censusbl>right_censusbl t_zlev>to_zlev "
    "f_cross>from_cross f_cross_st>from_cross_st t_cross>to_cross t_cross_st>to_cross_st "
    "logiclf>logic_left_from logiclt>logic_left_to logicrf>logic_right_from "
    "logicrt>logic_right_to streetname>street_id fnode_id>from_node_id tnode_id>to_node_id "
    "flag_strin>flag_string",
    int="l_t_add>left_to_addr l_f_add>left_from_add r_f_add>right_from_add r_t_add>right_to_addr "
    "ewns ewns_coord trans_id",
    date="status_dat>status_date create_tim>create_time update_tim>update_time",
    zero_or_date="edit_date",
    double="length shape_len",
    geometry="geometry",
)
_add(
    "chicago_towed_vehicles",
    "inventory_number tow_date plate",
    "vehicle_tow_id",
    **{"date__MM/dd/yyyy": "tow_date"},
    varchar__4="make",
    varchar__3="model",
    varchar__2="style",
    char__3="color",
    varchar__10="plate",
    char__2="state",
    digits_only="tow_facility_phone",
)
_add(
    "chicago_traffic_congestion",
    "segmentid",
    bigint="segmentid _current_speed>current_speed",
    double="length start_longitude _start_latitude>start_latitude end_longitude "
    "_end_latitude>end_latitude",
    text="_street_heading>street_heading _comments>comments",
    zoned="_last_updated>last_updated",
)
_add(
    "chicago_traffic_crashes",
    "crash_record_id",
    zoned="crash_date date_police_notified",
    int="street_no lane_cnt",
    char__1="street_direction workers_present_i crash_date_est_i photos_taken_i "
    "private_property_i intersection_related_i statements_taken_i hit_and_run_i work_zone_i "
    "dooring_i",
    smallint="crash_month crash_day_of_week crash_hour injuries_fatal "
    "injuries_non_incapacitating injuries_incapacitating injuries_no_indication "
    "injuries_unknown injuries_reported_not_evident injuries_total num_units "
    "posted_speed_limit beat_of_occurrence",
    double="latitude longitude",
    geometry="geometry",
)
_add(
    "chicago_vacant_and_abandoned_buildings",
    "violation_number property_address entity_or_person",
    "vacant_bldg_violation_id",
    text="entity_or_person_s_>entity_or_person",
    date="issued_date",
    zoned="last_hearing_date",
    numeric__8__2="total_fines interest_amount total_administrative_costs "
    "original_total_amount_due collection_costs_or_attorney_fees court_cost total_paid "
    "current_amount_due",
    double="latitude longitude",
    geometry_or_null__POINT="geometry",
)

# County tables
_add(
    "cook_county_areawaters_2022",
    "hydroid",
    bigint="vintage_year aland>area_land awater>area_water",
    double="ansicode intptlon>longitude intptlat>latitude",
    geometry__POLYGON="geometry",
    srid=4269,
)
_add(
    "cook_county_linear_water_2024",
    "linearid",
    bigint="vintage_year",
    geometry__LINESTRING="geometry",
    srid=4269,
)
_add(
    "cook_county_multifam_parcel_improvements",
    "pin tax_year card_num",
    "res_parcel_improvement_id",
    bigint="pin tax_year card_num land_sqft",
    varchar__3="class",
    varchar__2="township_code",
    char__2="cdu",
    boolean="renovation recent_renovation pin_is_multicard pin_is_multiland garage_attached "
    "garage_area_included",
    smallint="pin_num_cards pin_num_landlines year_built num_bedrooms num_rooms num_full_baths "
    "num_half_baths num_fireplaces num_commercial_units",
    int="building_sqft",
)
_add(
    "cook_county_neighborhood_boundaries",
    "town_nbhd triad_code",
    "nbhd_boundary_id",
    char__1="triad_code",
    padded_char__2="township_code",
    padded_char__3="nbhd",
    geometry__MULTIPOLYGON="geometry",
    derived=_parts(),
)
_add(
    "cook_county_parcel_assessment_appeals",
    "rowid",
    bigint="pin pin10",
    year_start="tax_year",
    real_bigint="bor_landvalue bor_improvementvalue bor_totalvalue assessor_landvalue "
    "assessor_improvementvalue assessor_totalvalue",
    double="xcoord_crs_3435 ycoord_crs_3435 lat long",
    geometry__POINT="geometry",
)
_add(
    "cook_county_parcel_locations",
    "pin",
    bigint="pin",
    int="ward tract_pop tract_midincome reps_dist senate_dist fs_flood_risk_direction",
    double="tract_white_perc tract_black_perc tract_asian_perc tract_his_perc tract_other_perc "
    "longitude latitude",
    varchar__5="commissioner_dist",
    padded_char__5="mailing_zip",
    padded_int__2="township",
    padded_int__3__3="nbhd",
    padded_int__4__4="municipality_fips puma",
    padded_int__8__8="tif_agencynum",
    padded_int__11__11="tract_geoid",
    int_boolean="ohare_noise floodplain fs_flood_factor withinmr100 withinmr101300 "
    "indicator_has_address indicator_has_latlon",
    derived={"geometry": lambda: point("longitude", "latitude")},
)
_add(
    "cook_county_parcel_proximity",
    "pin year",
    "pin_year_id",
    bigint="pin10>pin year num_pin_in_half_mile num_foreclosure_in_half_mile_past_5_years "
    "nearest_cemetery_gnis_code nearest_cta_stop_id nearest_hospital_gnis_code "
    "nearest_major_road_osm_id nearest_park_osm_id nearest_secondary_road_osm_id "
    "nearest_water_id nearest_neighbor_1_pin10 nearest_neighbor_2_pin10 "
    "nearest_neighbor_3_pin10",
    smallint="num_bus_stop_in_half_mile num_school_in_half_mile nearest_railroad_id",
    double="num_foreclosure_per_1000_pin_past_5_years airport_dnl_total",
    patterns={r".*_dist_ft": "double", r"(?!num_foreclosure_).*_data_year": "smallint"},
)
_add(
    "cook_county_parcel_sales",
    "pin sale_document_num sale_date sale_price",
    "parcel_sale_id",
    bigint="pin sale_price township_code",
    date="sale_date",
    boolean="is_mydec_date is_multisale",
    int="year num_parcels_sale",
    class_code="class",
)
_add(
    "cook_county_parcel_value_assessments",
    "pin tax_year",
    "parcel_assessment_id",
    bigint="pin",
    int="tax_year",
    padded_int__2__2="township_code",
    patterns={r"(mailed|certified|board)_(bldg|land|tot)": "double"},
)
_add(
    "cook_county_roads_2022",
    "linearid",
    bigint="vintage_year",
    geometry__LINESTRING="geometry",
    srid=4269,
)
_CASE_DATES = "received_date incident_begin_date incident_end_date felony_review_date"
_add(
    "cook_county_sao_case_disposition_data",
    "case_participant_id charge_id",
    "charge_disposition_id",
    bigint="case_participant_id charge_id charge_version_id case_id",
    smallint="charge_count age_at_incident",
    gender="gender",
    date=f"{_CASE_DATES} disposition_date arraignment_date",
    boolean="primary_charge_flag",
    zoned="arrest_date",
)
_add(
    "cook_county_sao_case_diversion_data",
    "case_participant_id diversion_program",
    "participant_diversion_id",
    bigint="case_participant_id case_id",
    date="received_date referral_date diversion_closed_date",
    smallint="diversion_count",
    gender="gender",
)
_add(
    "cook_county_sao_case_initiation_data",
    "case_participant_id charge_id",
    "case_initiation_id",
    bigint="case_participant_id case_id charge_id charge_version_id charge_count "
    "bond_amount_initial bond_amount_current",
    date=f"{_CASE_DATES} arraignment_date bond_date_initial bond_date_current",
    boolean="primary_charge_flag bond_electronic_monitor_flag_initial "
    "bond_electroinic_monitor_flag_current",
    int_boolean="finding_no_probable_cause",
    smallint="age_at_incident",
    gender="gender",
    zoned="event_date arrest_date",
)
_add(
    "cook_county_sao_case_intake_data",
    "case_participant_id",
    bigint="case_participant_id case_id",
    date=_CASE_DATES,
    smallint="age_at_incident",
    gender="gender",
    zoned="arrest_date",
)
_add(
    "cook_county_sao_case_sentencing_data",
    "case_participant_id charge_id sentence_phase sentence_date sentence_type "
    "current_sentence_flag commitment_type commitment_term",
    "charge_sentence_id",
    bigint="case_participant_id case_id charge_id charge_version_id charge_count "
    "length_of_case_in_days",
    date=f"{_CASE_DATES} arraignment_date disposition_date sentence_date",
    boolean="primary_charge_flag current_sentence_flag",
    smallint="age_at_incident",
    gender="gender",
    zoned="arrest_date",
)

# Other places
_AREA = "vintage_year aland>area_land awater>area_water"
_CENTRE = "intptlon>longitude intptlat>latitude"
_add(
    "illinois_census_tracts_2022",
    "geoid",
    bigint=_AREA,
    double=_CENTRE,
    geometry="geometry",
    srid=4269,
)
_add(
    "nyc_parcel_sales",
    "address lot sale_price block sale_date",
    "nyc_parcel_sale_id",
    date="sale_date",
    smallint="block lot borough residential_units commercial_units total_units",
    int="gross_square_feet",
    comma_bigint="sale_price",
    comma_int="land_square_feet",
    year_start="year_built",
)
_add(
    "united_states_counties_2022",
    "geoid",
    bigint=_AREA,
    double=f"csafp cbsafp metdivfp {_CENTRE}",
    geometry="geometry",
    srid=4269,
)
_add(
    "united_states_counties_2024",
    "geoid",
    bigint=_AREA,
    double=_CENTRE,
    geometry="geometry",
    srid=4269,
)
_add(
    "united_states_rails_2022",
    "linearid",
    bigint="vintage_year",
    geometry__LINESTRING="geometry",
    srid=4269,
)

# Kept as distinct versions only, not standardized
RAW_ONLY = (
    "chicago_311_service_requests",
    "chicago_business_licenses",
    "chicago_libraries",
    "chicago_recycling_dropoff_sites",
    "chicago_red_light_camera_violations",
    "cook_county_address_points",
    "cook_county_parcel_addresses",
    "cook_county_condo_parcel_improvements",
    "gross_rent_by_illinois_tract",
)
