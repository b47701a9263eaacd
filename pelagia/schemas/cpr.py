"""Declared tables of the towed-recorder (CPR) programme."""

from .spec import table

CPR_SAMP = table(
    "cpr_samp",
    key="sample",
    fields="""
        trip_code       string required
        sample          string required
        region          string required
        latitude        double required
        longitude       double required
        sampledateutc   datetime required
        sampledatelocal datetime
        pci             double
        biomass_mgm3    double
        sampletype      string
        ghrsst_6d_degc  double
        chloc3_mgm3     double
    """,
    ranges={"longitude": (-180, 180), "latitude": (-90, 90)},
)

CPR_PHYTO_RAW = table(
    "cpr_phyto_raw",
    key="sample taxon_name",
    fields="""
        sample             string required
        taxon_name         string required
        taxon_group        string required
        genus              string
        species            string
        spcode             bigint
        phyto_abundance_m3 double required
        biovol_um3m3       double
        fov_count          double required
        sampvol_m3         double required
    """,
)

CPR_PHYTO_CHANGELOG = table(
    "cpr_phyto_changelog",
    key="taxon_name",
    fields="""
        taxon_name  string required
        startdate   date required
        parent_name string
        training    string
        comments    string
    """,
)

CPR_ZOOP_RAW = table(
    "cpr_zoop_raw",
    key="sample taxon_name",
    fields="""
        sample            string required
        taxon_name        string required
        copepod           string required
        taxon_group       string required
        genus             string
        species           string
        spcode            bigint
        taxon_count       double required
        sampvol_m3        double required
        zoop_abundance_m3 double required
    """,
)

CPR_ZOOP_CHANGELOG = table(
    "cpr_zoop_changelog",
    key="taxon_name",
    fields="""
        taxon_name  string required
        startdate   date required
        parent_name string
        training    string
        comments    string
    """,
)

TABLES = (CPR_SAMP, CPR_PHYTO_RAW, CPR_PHYTO_CHANGELOG, CPR_ZOOP_RAW, CPR_ZOOP_CHANGELOG,)
