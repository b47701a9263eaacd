"""Tables the CTD jobs read that come without a published schema; types follow from use."""

from .spec import table

DEPLOYMENTS = table(
    "deployments",
    key="file_id",
    fields="""
        file_id             bigint required
        site_code           string
        time_coverage_start datetime
    """,
)

MEASUREMENTS = table(
    "measurements",
    key="file_id depth",
    # Measured quantities in the order they are published.
    fields="""
        file_id              bigint required
        depth                double
        psal                 double
        psal_quality_control string
        temp                 double
        temp_quality_control string
        dox2                 double
        dox2_quality_control string
        cphl                 double
        cphl_quality_control string
        turb                 double
        turb_quality_control string
        cndc                 double
        cndc_quality_control string
        dens                 double
        dens_quality_control string
    """,
)

DETECTION_FILE_INDEX = table(
    "detection_file_index",
    key="tag_deployment_id",
    fields="""
        tag_deployment_id       string required
        transmitter_id          string
        species                 string
        species_scientific_name string
        tagging_project         string
        time_coverage_start     datetime
        time_coverage_end       datetime
        geom                    string
        first_indexed           datetime
        last_indexed            datetime
        url                     string
        size                    bigint
    """,
)

TABLES = (DEPLOYMENTS, MEASUREMENTS, DETECTION_FILE_INDEX)
