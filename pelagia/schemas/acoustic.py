"""Declared tables of the acoustic animal-tracking programme."""

from .spec import table

# The patterns and formats that published files must follow.
TRANSMITTER = r"^(?:A(?:69|180)-\d{4}-\d{1,5})"
ANIMAL = r"^(?:A(?:69|180)-\d{4}-\d{1,5}_){1,3}\d{1,10}_\d{1,10}"
DAY_OR_SECOND = r"^(\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?)$"
MISSING = ("", " ", "NA")

DETECTION_INDEX_BATCH = table(
    "detection_index_batch",
    key="tag_deployment_id",
    fields="""
        tag_deployment_id       string required
        transmitter_id          string required
        species                 string
        species_scientific_name string required
        tagging_project         string required
        time_coverage_start     datetime_t required
        time_coverage_end       datetime_t required
        geom_df                 string required
        url                     string required
        size                    bigint required
    """,
)

ACOUSTIC_DETECTIONS_QC = table(
    "acoustic_detections_qc",
    key="",
    fields="""
        transmitter_id                     string required
        tag_id                             bigint required
        transmitter_deployment_id          bigint required
        tag_deployment_project_name        string required
        species_common_name                string required
        species_scientific_name            string required
        caab_species_id                    bigint required
        worms_species_aphia_id             bigint
        animal_sex                         string required
        detection_datetime                 datetime_z required
        receiver_deployment_longitude      double required
        receiver_deployment_latitude       double required
        receiver_project_name              string required
        installation_name                  string required
        station_name                       string required
        receiver_name                      string required
        receiver_id                        bigint required
        receiver_deployment_id             bigint required
        receiver_depth                     double
        purchasing_organisation            string
        receiver_status                    string
        receiver_deployment_datetime       string required
        receiver_recovery_datetime         string required
        receiver_recovery_longitude        double
        receiver_recovery_latitude         double
        tag_device_project_name            string required
        transmitter_sensor_type            string required
        transmitter_sensor_raw_value       double
        transmitter_sensor_unit            string
        transmitter_sensor_slope           double
        transmitter_sensor_intercept       double
        transmitter_type                   string required
        transmitter_serial_number          string
        transmitter_estimated_battery_life bigint
        transmitter_status                 string
        transmitter_deployment_longitude   double required
        transmitter_deployment_latitude    double required
        transmitter_deployment_datetime    string required
        transmitter_dual_sensor            boolean required
        active                             string
        placement                          string
        transmitter_deployment_locality    string
        transmitter_deployment_comments    string
        transmitter_recovery_datetime      string
        transmitter_recovery_latitude      double
        transmitter_recovery_longitude     double
        measurement                        string
        fda_qc                             bigint
        velocity_qc                        bigint
        distance_qc                        bigint
        detectiondistribution_qc           bigint
        distancerelease_qc                 bigint
        releasedate_qc                     bigint
        releaselocation_qc                 bigint
        detection_qc                       bigint
    """,
    patterns={
        "transmitter_id": TRANSMITTER,
        "receiver_deployment_datetime": DAY_OR_SECOND,
        "receiver_recovery_datetime": DAY_OR_SECOND,
        "transmitter_deployment_datetime": DAY_OR_SECOND,
        "transmitter_recovery_datetime": DAY_OR_SECOND,
    },
    missing=MISSING,
)

ACOUSTIC_SUMMARY_QC = table(
    "acoustic_summary_qc",
    key="",
    fields="""
        animal_id                           string required
        date_utc                            date required
        nb_detections                       bigint required
        species_common_name                 string required
        species_scientific_name             string required
        caab_species_id                     bigint
        worms_species_aphia_id              bigint
        animal_sex                          string
        measurement                         string
        transmitter_deployment_locality     string
        transmitter_deployment_longitude    double required
        transmitter_deployment_latitude     double required
        transmitter_deployment_datetime_utc string required
        transmitter_sensor_type             string required
        transmitter_sensor_mean_value       string
        transmitter_sensor_unit             string
        transmitter_sensor_intercept        string
        transmitter_sensor_slope            string
        tag_deployment_project_name         string required
        installation_name                   string required
        station_name                        string required
        receiver_project_name               string required
        receiver_name                       string required
        receiver_deployment_id              bigint required
        receiver_deployment_datetime_utc    string required
        receiver_recovery_datetime_utc      string required
        receiver_deployment_longitude       double required
        receiver_deployment_latitude        double required
    """,
    patterns={
        "animal_id": ANIMAL,
        "receiver_deployment_datetime_utc": DAY_OR_SECOND,
        "receiver_recovery_datetime_utc": DAY_OR_SECOND,
    },
    soft_patterns={"transmitter_deployment_datetime_utc": DAY_OR_SECOND},
    missing=MISSING,
)

ACOUSTIC_DETECTIONS = table(
    "acoustic_detections",
    key="",
    fields="""
        transmitter_id                     string required
        tag_id                             bigint required
        transmitter_deployment_id          bigint required
        tag_deployment_project_name        string required
        species_common_name                string required
        species_scientific_name            string required
        caab_species_id                    bigint required
        worms_species_aphia_id             bigint
        animal_sex                         string required
        detection_datetime                 datetime_z required
        receiver_deployment_longitude      double required
        receiver_deployment_latitude       double required
        receiver_project_name              string required
        installation_name                  string required
        station_name                       string required
        receiver_name                      string required
        receiver_id                        bigint required
        receiver_deployment_id             bigint required
        receiver_depth                     string
        purchasing_organisation            string
        receiver_status                    string
        receiver_deployment_datetime       date_any required
        receiver_recovery_datetime         date_any required
        receiver_recovery_longitude        double
        receiver_recovery_latitude         double
        tag_device_project_name            string required
        transmitter_sensor_type            string required
        transmitter_sensor_raw_value       string
        transmitter_sensor_unit            string
        transmitter_sensor_slope           string
        transmitter_sensor_intercept       string
        transmitter_type                   string required
        transmitter_serial_number          string
        transmitter_estimated_battery_life bigint
        transmitter_status                 string
        transmitter_deployment_longitude   double required
        transmitter_deployment_latitude    double required
        transmitter_deployment_datetime    date_any required
        transmitter_dual_sensor            boolean required
        active                             string
        placement                          string
        transmitter_deployment_locality    string
        transmitter_deployment_comments    string
        transmitter_recovery_datetime      date_any
        transmitter_recovery_latitude      double
        transmitter_recovery_longitude     double
        measurement                        string
        fda_qc                             bigint
        velocity_qc                        bigint
        distance_qc                        bigint
        detectiondistribution_qc           bigint
        distancerelease_qc                 bigint
        releasedate_qc                     bigint
        releaselocation_qc                 bigint
        detection_qc                       bigint
    """,
    missing=MISSING,
)

TABLES = (DETECTION_INDEX_BATCH, ACOUSTIC_DETECTIONS_QC, ACOUSTIC_SUMMARY_QC, ACOUSTIC_DETECTIONS,)
