"""Column lists of the published tables. Fixed values, spelled out, so that a published column can be searched for."""

from __future__ import annotations


class Layout(dict):
    """{table: columns}, with the key columns of its hubs and links in ``keys_of``."""

    def __init__(self, tables: dict[str, list[str]], keys_of: dict[str, list[str]]):
        super().__init__(tables)
        self.keys_of = keys_of


# a flight link has no column of the crew or the recording: every different row of it counts
AVIATION = Layout(
    {
        "LINK_Flight_Crew": [
            "event_id", "event_openid", "customer_code", "ocurrence_datetime", "source_sourcefilename",
        ],
        "LINK_Flight_IOT": [
            "event_id", "event_openid", "customer_code", "ocurrence_datetime", "source_sourcefilename",
        ],
        "SAT_IOT_Records": [
            "event_id", "selected_altitude_mt", "avg_altitude_mt_cruise", "cd_behaviour_success", "taxi_out_minutes",
            "avg_speed_knots_cruise", "total_approach_fuel_burned", "total_dfa_fuel_burned", "origin", "destination",
            "fuel_burn_taxi_out1", "fuel_burn_taxi_in1", "fuel_burn_taxi_out2", "departure_rwy", "plnd_block_fuel",
            "arrival_rwy", "role_alias", "operator_id", "ocurrence_datetime", "source_sourcefilename",
        ],
        "SAT_Flight_IOT_Stats": [
            "event_id", "selected_altitude_mt", "avg_altitude_mt_cruise", "avg_speed_knots_cruise", "air_minutes",
            "ground_minutes", "act_bloff_fuel", "takeoff_fuel", "cruise_start_time", "cruise_end_time",
            "landing_fuel", "gate_fuel", "taxi_out_minutes", "cruise_minutes", "descent_fuel", "taxi_in_minutes",
            "plnd_tanker_fuel", "total_engine1_runtime_mins", "total_engine2_runtime_mins", "fuel_burn_total1",
            "fuel_burn_total2", "fuel_burn_taxi_out1", "fuel_burn_taxi_out2", "fuel_burn_taxi_in1",
            "fuel_burn_taxi_in2", "flaps_deployed_altitude", "flaps_deployed_distance", "flaps_deployed_speed",
            "tom_trip_coefficient_x3", "tom_trip_coefficient_x2", "tom_trip_coefficient_x",
            "tom_trip_coefficient_intercept", "ocurrence_datetime", "source_sourcefilename",
        ],
        "HUB_Crew_Member": ["operator_id", "ocurrence_datetime", "source_sourcefilename"],
        "SAT_Crew_Member": [
            "operator_uuid", "operator_code_1", "operator_secondary_code", "operator_name", "operator_lastname",
            "role_alias", "team_id", "team_name", "vehicle_email_operator1", "ocurrence_datetime",
            "source_sourcefilename",
        ],
        "HUB_Flight": ["event_id", "ocurrence_datetime", "file_sources", "event_key"],
        "SAT_Flight_Planned": [
            "event_key", "event_openid", "haul_type", "vehicle", "flight_number_iata", "flight_number_icao",
            "dds_code", "origin", "departure_rwy", "destination", "arrival_rwy", "route_distance", "planned_zfw",
            "total_pax_qty", "plnd_arrival_time", "ocurrence_datetime", "plnd_departure_time",
        ],
        "SAT_Fuel_Planned": [
            "event_key", "plnd_block_fuel", "planned_extra_fuel", "planned_discretionary_fuel",
            "planned_contingency_fuel", "planned_alternate_fuel", "planned_final_reserve_fuel", "planned_tanker_fuel",
            "planned_taxi_fuel", "fuel_burn_reto_1_without_warmup", "planned_trip_fuel", "planned_takeoff_fuel",
            "planned_arrival_fuel", "planned_landing_fuel", "ocurrence_datetime", "source_sourcefilename",
        ],
        "SAT_Fuel_Actual": [
            "event_key", "fuel_burn_reti_main_engine", "planned_extra_fuel", "planned_discretionary_fuel",
            "planned_contingency_fuel", "planned_alternate_fuel", "planned_final_reserve_fuel", "planned_tanker_fuel",
            "fuel_burn_reto_main_engine", "planned_takeoff_fuel", "planned_arrival_fuel", "planned_landing_fuel",
            "ocurrence_datetime", "source_sourcefilename",
        ],
        "SAT_Flight_Actual": [
            "event_key", "event_openid", "vehicle", "flight_number_iata", "flight_number_icao", "dds_code", "origin",
            "departure_rwy", "plnd_departure_time", "destination", "arrival_rwy", "plnd_arrival_time",
            "route_distance", "actual_zfw", "total_pax_qty", "ocurrence_datetime", "source_sourcefilename",
        ],
        "HUB_Time": ["event_id", "plnd_departure_time", "ocurrence_datetime", "source_sourcefilename"],
        "SAT_Behaviours": [
            "event_key", "event_openid", "reti__net_savings", "reti__success", "reti__savings",
            "reti__best_case_savings", "reti__reason", "reto__net_savings", "reto__success", "reto__savings",
            "reto__best_case_savings", "reto__reason", "reto__other_reasons", "ef__net_savings", "ef__success",
            "ef__savings", "ef__best_case_savings", "ef__reason", "odfl__net_savings", "odfl__success",
            "odfl__savings", "odfl__best_case_savings", "odfl__reason",
        ],
    },
    {
        "LINK_Flight_Crew": ["event_id", "event_openid", "customer_code", "ocurrence_datetime", "source_sourcefilename"],
        "LINK_Flight_IOT": ["event_id", "event_openid", "customer_code", "ocurrence_datetime", "source_sourcefilename"],
        "HUB_Crew_Member": ["operator_id"],
        "HUB_Flight": ["event_id"],
        "HUB_Time": ["event_id", "plnd_departure_time"],
    },
)

TANKER = Layout(
    {
        "LINK_Ship_Daily_Crew": ["hk_ship_day_id", "hk_operator_id", "load_date", "record_source"],
        "HUB_Crew_Member": ["hk_operator_id", "load_date", "record_source"],
        "SAT_Crew_Member": [
            "hk_operator_id", "operator_code", "operator_license", "operator_name", "operator_email", "operator_role",
            "load_date", "record_source",
        ],
        "HUB_Ship_Day": ["hk_ship_day_id", "ship_imo", "sea_date", "load_date", "record_source"],
        "SAT_Voyage_Details": [
            "hk_ship_day_id", "ship_name", "ship_type", "ship_engine_type", "voyage_type", "voyage_number",
            "departure_port", "arrival_port", "departure_time", "arrival_time", "voyage_duration_days", "load_date",
            "record_source",
        ],
        "SAT_Daily_Stats": [
            "hk_ship_day_id", "voyage_leg_id", "terminal", "position", "day", "origin_port", "next_port", "status",
            "log_hours", "steaming_hours", "manouvering_hours", "port_hours", "sea_hours", "speed_water",
            "observed_distance", "main_engine_1_running_hours", "main_engine_2_running_hours",
            "main_engine_3_running_hours", "main_engine_4_running_hours", "main_engine_1_electric_power",
            "main_engine_2_electric_power", "main_engine_3_electric_power", "main_engine_4_electric_power",
            "aux_engine_1_running_hours", "aux_engine_2_running_hours", "aux_engine_3_running_hours",
            "aux_engine_4_running_hours", "aux_engine_5_running_hours", "aux_engine_6_running_hours",
            "aux_engine_1_electric_power", "aux_engine_2_electric_power", "aux_engine_3_electric_power",
            "aux_engine_4_electric_power", "aux_engine_5_electric_power", "aux_engine_6_electric_power",
            "main_engine_sfoc", "aux_engine_sfoc", "aft_draft", "fwd_draft", "draft_type", "wind_speed",
            "wind_direction", "swell_height", "sea_height", "sea_temperature", "beaufort", "trim", "load_date",
            "record_source",
        ],
        "SAT_Report_Records": [
            "hk_ship_day_id", "report_source_id", "report_time_utc", "report_type", "operational_mode", "log_hours",
            "latitude", "longitude", "remarks", "report_data_json", "load_date", "record_source",
        ],
        "SAT_Logbook_Records": [
            "hk_ship_day_id", "logbook_source_id", "logbook_reported_time_utc", "logbook_reported_by", "logbook_book",
            "logbook_category", "logbook_summary", "logbook_field_name", "logbook_field_value", "logbook_field_unit",
            "load_date", "record_source",
        ],
        "SAT_Constant_Params": [
            "hk_ship_day_id", "param_name", "param_value", "param_description", "load_date", "record_source",
        ],
        "SAT_Behaviours": [
            "hk_ship_day_id", "eaeu__net_savings", "eaeu__success", "eaeu__savings", "eaeu__best_case_savings",
            "eaeu__reason", "eaeu__succeeded_predicted", "emo__net_savings", "emo__success", "emo__savings",
            "emo__best_case_savings", "emo__reason", "emo__succeeded_predicted", "optimal_trim__net_savings",
            "optimal_trim__success", "optimal_trim__savings", "optimal_trim__best_case_savings",
            "optimal_trim__reason", "optimal_trim__succeeded_predicted", "epm__net_savings", "epm__success",
            "epm__savings", "epm__best_case_savings", "epm__reason", "epm__succeeded_predicted",
        ],
    },
    {
        "LINK_Ship_Daily_Crew": ["hk_ship_day_id", "hk_operator_id"],
        "HUB_Crew_Member": ["hk_operator_id"],
        "HUB_Ship_Day": ["hk_ship_day_id"],
    },
)

CHARTER = Layout(
    {
        "LINK_Ship_Daily_Crew": ["ship_day_id", "operator_id", "load_date", "record_source"],
        "HUB_Crew_Member": ["operator_id", "load_date", "record_source"],
        "SAT_Crew_Member": [
            "operator_id", "operator_code", "operator_license", "operator_name", "operator_email", "operator_role",
            "load_date", "record_source",
        ],
        "HUB_Ship_Day": ["ship_day_id", "ship_imo", "sea_date", "load_date", "record_source"],
        "SAT_Voyage_Details": [
            "ship_day_id", "ship_name", "ship_type", "ship_engine_type", "voyage_type", "voyage_number",
            "departure_port", "arrival_port", "departure_time", "arrival_time", "voyage_duration_days", "load_date",
            "record_source",
        ],
        "SAT_Daily_Stats": [
            "ship_day_id", "voyage_leg_id", "terminal", "position", "day", "origin_port", "next_port", "status",
            "log_hours", "steaming_hours", "manouvering_hours", "port_hours", "sea_hours", "speed_water",
            "observed_distance", "main_engine_1_running_hours", "main_engine_2_running_hours",
            "main_engine_3_running_hours", "main_engine_4_running_hours", "main_engine_1_electric_power",
            "main_engine_2_electric_power", "main_engine_3_electric_power", "main_engine_4_electric_power",
            "aux_engine_1_running_hours", "aux_engine_2_running_hours", "aux_engine_3_running_hours",
            "aux_engine_4_running_hours", "aux_engine_5_running_hours", "aux_engine_6_running_hours",
            "aux_engine_1_electric_power", "aux_engine_2_electric_power", "aux_engine_3_electric_power",
            "aux_engine_4_electric_power", "aux_engine_5_electric_power", "aux_engine_6_electric_power",
            "main_engine_sfoc", "aux_engine_sfoc", "aft_draft", "fwd_draft", "draft_type", "wind_speed",
            "wind_direction", "swell_height", "sea_height", "sea_temperature", "beaufort", "trim", "load_date",
            "record_source",
        ],
        "SAT_Report_Records": [
            "ship_day_id", "report_source_id", "report_time_utc", "report_type", "operational_mode", "log_hours",
            "latitude", "longitude", "remarks", "report_data_json", "load_date", "record_source",
        ],
        "SAT_Logbook_Records": [
            "ship_day_id", "logbook_source_id", "logbook_reported_time_utc", "logbook_reported_by", "logbook_book",
            "logbook_category", "logbook_summary", "logbook_field_name", "logbook_field_value", "logbook_field_unit",
            "load_date", "record_source",
        ],
        "SAT_Constant_Params": [
            "ship_day_id", "param_name", "param_value", "param_description", "load_date", "record_source",
        ],
        "SAT_Behaviours": [
            "ship_day_id", "eaeu__net_savings", "eaeu__success", "eaeu__savings", "eaeu__best_case_savings",
            "eaeu__reason", "eaeu__succeeded_predicted", "emo__net_savings", "emo__success", "emo__savings",
            "emo__best_case_savings", "emo__reason", "emo__succeeded_predicted", "et__net_savings", "et__success",
            "et__savings", "et__best_case_savings", "et__reason", "et__succeeded_predicted",
        ],
    },
    {
        "LINK_Ship_Daily_Crew": ["ship_day_id", "operator_id"],
        "HUB_Crew_Member": ["operator_id"],
        "HUB_Ship_Day": ["ship_day_id"],
    },
)

SEA = Layout(
    {
        "LINK_Ship_Daily_Crew": [
            "event_key", "event_id", "ship_day_id", "operator_id", "operator_id2", "load_date", "record_source",
        ],
        "HUB_Crew_Member": ["event_key", "event_id", "operator_id", "operator_id2", "load_date", "record_source"],
        "SAT_Crew_Member": [
            "event_key", "event_id", "operator_id", "operator_id2", "operator_code", "operator_license",
            "operator_name", "operator_lastname", "operator_email", "operator_role", "load_date", "record_source",
        ],
        "HUB_Ship_Day": [
            "event_key", "event_id", "ship_day_id", "imo", "sea_date", "load_date", "record_source", "customer_name",
            "customer_code", "vehicle",
        ],
        "SAT_Voyage_Details": [
            "event_key", "event_id", "ship_day_id", "vehicle", "ship_type", "ship_engine_type", "voyage_type",
            "voyage_number", "departure_port", "arrival_port", "departure_time", "arrival_time",
            "voyage_duration_days", "load_date", "record_source",
        ],
        "SAT_Daily_Stats": [
            "event_key", "event_id", "ship_day_id", "voyage_leg_id", "terminal", "position", "day", "origin_port",
            "next_port", "status", "log_hours", "steaming_hours", "manouvering_hours", "port_hours", "sea_hours",
            "speed_water", "observed_distance", "main_engine_1_running_hours", "main_engine_2_running_hours",
            "main_engine_3_running_hours", "main_engine_4_running_hours", "main_engine_1_electric_power",
            "main_engine_2_electric_power", "main_engine_3_electric_power", "main_engine_4_electric_power",
            "aux_engine_1_running_hours", "aux_engine_2_running_hours", "aux_engine_3_running_hours",
            "aux_engine_4_running_hours", "aux_engine_5_running_hours", "aux_engine_6_running_hours",
            "aux_engine_1_electric_power", "aux_engine_2_electric_power", "aux_engine_3_electric_power",
            "aux_engine_4_electric_power", "aux_engine_5_electric_power", "aux_engine_6_electric_power",
            "main_engine_sfoc", "aux_engine_sfoc", "aft_draft", "fwd_draft", "draft_type", "wind_speed",
            "wind_direction", "swell_height", "sea_height", "sea_temperature", "beaufort", "trim", "load_date",
            "record_source",
        ],
        "SAT_Report_Records": [
            "event_key", "event_id", "ship_day_id", "report_source_id", "report_time_utc", "report_type",
            "operational_mode", "log_hours", "latitude", "longitude", "remarks", "report_data_json", "load_date",
            "record_source",
        ],
        "SAT_Logbook_Records": [
            "event_key", "event_id", "ship_day_id", "logbook_source_id", "logbook_reported_time_utc",
            "logbook_reported_by", "logbook_book", "logbook_category", "logbook_summary", "logbook_field_name",
            "logbook_field_value", "logbook_field_unit", "load_date", "record_source",
        ],
        "SAT_Constant_Params": [
            "event_key", "event_id", "ship_day_id", "param_name", "param_value", "param_description", "load_date",
            "record_source",
        ],
        "SAT_Behaviours": [
            "event_key", "event_id", "ship_day_id", "eaeu__net_savings", "eaeu__success", "eaeu__savings",
            "eaeu__best_case_savings", "eaeu__reason", "eaeu__succeeded_predicted", "emo__net_savings",
            "emo__success", "emo__savings", "emo__best_case_savings", "emo__reason", "emo__succeeded_predicted",
            "optimal_sailing__net_savings", "optimal_sailing__success", "optimal_sailing__savings",
            "optimal_sailing__best_case_savings", "optimal_sailing__reason", "optimal_sailing__succeeded_predicted",
            "epm__net_savings", "epm__success", "epm__savings", "epm__best_case_savings", "epm__reason",
            "epm__succeeded_predicted", "optimal_trim__net_savings", "optimal_trim__success", "optimal_trim__savings",
            "optimal_trim__best_case_savings", "optimal_trim__reason", "optimal_trim__succeeded_predicted",
            "et__net_savings", "et__success", "et__savings", "et__best_case_savings", "et__reason",
            "et__succeeded_predicted",
        ],
    },
    {
        "LINK_Ship_Daily_Crew": ["event_key", "event_id", "ship_day_id", "operator_id", "operator_id2"],
        "HUB_Crew_Member": ["event_key", "event_id", "operator_id", "operator_id2"],
        "HUB_Ship_Day": ["event_key", "event_id", "ship_day_id"],
    },
)
