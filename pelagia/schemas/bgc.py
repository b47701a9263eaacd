"""Declared tables of the station-visit (BGC) programme."""

from .spec import table

BGC_TRIP = table(
    "bgc_trip",
    key="trip_code",
    fields="""
        projectname         string required
        trip_code           string required
        stationname         string required
        stationcode         string required
        longitude           double required
        latitude            double required
        zoopsampledepth_m   double
        phytosampledepth_m  double
        sampledatelocal     datetime
        sampledateutc       datetime required
        biomass_mgm3        double
        ashfreebiomass_mgm3 double
        secchi_m            double
        sampletype          string
    """,
    ranges={"longitude": (-180, 180), "latitude": (-90, 90)},
)

BGC_PHYTO_RAW = table(
    "bgc_phyto_raw",
    key="trip_code taxon_name methods",
    fields="""
        trip_code      string required
        taxon_name     string required
        taxon_group    string required
        genus          string
        species        string
        spcode         bigint
        cell_l         double required
        biovolume_um3l double
        cell_count     double
        sampvol_l      double
        methods        string
        comments       string
    """,
)

BGC_PHYTO_CHANGELOG = table(
    "bgc_phyto_changelog",
    key="taxon_name",
    fields="""
        taxon_name  string required
        startdate   date required
        parent_name string
        training    string
        comments    string
    """,
)

BGC_ZOOP_RAW = table(
    "bgc_zoop_raw",
    key="trip_code taxon_name",
    fields="""
        trip_code         string required
        taxon_name        string required
        copepod           string required
        taxon_group       string required
        genus             string
        species           string
        spcode            string
        zoop_abundance_m3 double required
        taxon_count       double required
        sampvol_m3        double required
    """,
)

BGC_ZOOP_CHANGELOG = table(
    "bgc_zoop_changelog",
    key="taxon_name",
    fields="""
        taxon_name  string required
        startdate   date required
        parent_name string
        training    string
        comments    string
    """,
)

BGC_CHEMISTRY = table(
    "bgc_chemistry",
    key="trip_code sampledepth_m",
    fields="""
        trip_code           string required
        sampledepth_m       double required
        sampledatelocal     datetime required
        salinity_psu        double
        salinity_flag       bigint required
        silicate_umoll      double
        silicate_flag       bigint required
        nitrate_umoll       double
        nitrate_flag        bigint required
        phosphate_umoll     double
        phosphate_flag      bigint required
        ammonium_umoll      double
        ammonium_flag       bigint required
        nitrite_umoll       double
        nitrite_flag        bigint required
        dic_umolkg          double
        carbon_flag         bigint required
        talkalinity_umolkg  double
        alkalinity_flag     bigint required
        oxygen_umoll        double
        oxygen_flag         bigint required
        microbiomesample_id string
    """,
)

BGC_PICOPLANKTON = table(
    "bgc_picoplankton",
    key="trip_code sampledepth_m",
    fields="""
        trip_code               string required
        sampledepth_m           string required
        sampledatelocal         datetime required
        prochlorococcus_cellsml double
        synecochoccus_cellsml   double
        picoeukaryotes_cellsml  double
        bacteria_cellsml        double
        virus_cellsml           double
        prochlorococcus_flag    bigint
        synecochoccus_flag      bigint
        picoeukaryotes_flag     bigint
        bacteria_flag           bigint
        virus_flag              bigint
    """,
)

BGC_PICOPLANKTON_META = table(
    "bgc_picoplankton_meta",
    key="sample_code",
    fields="""
        trip_code                string required
        sample_code              string required
        sampledepth_m            string required
        sampledatelocal          datetime required
        replicate                bigint required
        prochlorococcus_cellsml  double
        synecochoccus_cellsml    double
        picoeukaryotes_cellsml   double
        bacteria_cellsml         double
        virus_cellsml            double
        prochlorococcus_flag     bigint
        synecochoccus_flag       bigint
        picoeukaryotes_flag      bigint
        bacteria_flag            bigint
        virus_flag               bigint
        pico_comments            string
        analysis_location        string
        analysis_date            date
        analyst_name             string
        temp_thawed_degc         double
        internal_standard        string
        instrument_brand_model   string
        instrument_serial_number string
        laser_nm                 string
        mode_type                string
        analysis_volume_ul       double
        flow_rate_ul_per_min     bigint
        analysis_time_minutes    bigint
        batch_comments           string
    """,
)

BGC_PIGMENTS = table(
    "bgc_pigments",
    key="trip_code sampledepth_m",
    fields="""
        trip_code            string required
        sampledatelocal      datetime required
        sampledepth_m        string required
        cphl_c3              double
        mg_dvp               double
        cphl_c2              double
        cphl_c1              double
        cphl_c1c2            double
        cphlide_a            double
        phide_a              double
        perid                double
        pyrophide_a          double
        but_fuco             double
        fuco                 double
        neo                  double
        keto_hex_fuco        double
        pras                 double
        viola                double
        hex_fuco             double
        asta                 double
        diadchr              double
        diadino              double
        dino                 double
        anth                 double
        allo                 double
        myxo                 double
        diato                double
        zea                  double
        lut                  double
        cantha               double
        gyro                 double
        dv_cphl_b            double
        cphl_b               double
        dv_cphl_b_and_cphl_b double
        dv_cphl_a            double
        cphl_a               double
        dv_cphl_a_and_cphl_a double
        echin                double
        phytin_b             double
        phytin_a             double
        lyco                 double
        beta_epi_car         double
        beta_beta_car        double
        alpha_beta_car       double
        pyrophytin_a         double
        pigments_flag        bigint required
        pigments_comments    string
    """,
)

BGC_TSS = table(
    "bgc_tss",
    key="trip_code sampledepth_m",
    fields="""
        trip_code             string required
        sampledatelocal       datetime required
        sampledepth_m         string required
        tss_mgl               double
        inorganicfraction_mgl double
        organicfraction_mgl   double
        tss_flag              bigint required
    """,
)

BGC_TSS_META = table(
    "bgc_tss_meta",
    key="trip_code sampledepth_m replicate",
    fields="""
        trip_code             string required
        sampledatelocal       datetime required
        sampledepth_m         string required
        replicate             bigint required
        tss_mgl               double
        inorganicfraction_mgl double
        organicfraction_mgl   double
        tss_flag              bigint required
        tss_comments          string
        blankadjustavailable  string
    """,
)

BGC_LFISH_SAMPLES = table(
    "bgc_lfish_samples",
    key="i_sample_id",
    fields="""
        i_sample_id     bigint required unique
        projectname     string required
        trip_code       string required
        sampledatelocal datetime required
        sampledateutc   datetime
        latitude        double required
        longitude       double required
        stationname     string
        sampvol_m3      double required
        vessel          string required
        towtype         string required
        geardepth_m     string
        gearmesh_um     string required
        depth_m         double
        temperature_c   double
        salinity_psu    double
        comments        string
        qc_flag         bigint required
        flag_comment    string
    """,
    ranges={"longitude": (-180, 180), "latitude": (-90, 90)},
)

BGC_LFISH_COUNTRAW = table(
    "bgc_lfish_countraw",
    key="i_sample_id scientificname",
    fields="""
        i_sample_id    bigint required
        trip_code      string required
        scientificname string required
        spcode         bigint required
        taxon_count    bigint required
        comments       string
    """,
)

ZOOPINFO = table(
    "zoopinfo",
    key="taxon_name",
    fields="""
        taxon_name      string required unique
        subgenera       string
        functionalgroup string
        genus           string
        species         string
        spcode          bigint
        length_mm       double
        sizereference   string
        diet            string
    """,
)

PHYTOINFO = table(
    "phytoinfo",
    key="taxon_name",
    fields="""
        spcode                bigint
        taxon_name            string required unique
        functionalgroup       string
        status                string
        valid_scientific_name string
        valid_aphia_id        bigint
        hab                   string
        bv_cell               double
        mont2001pgn_cell      double
        pgc_cell              double
        trophy                string
    """,
)

BGC_STATIONINFO = table(
    "bgc_stationinfo",
    key="stationcode",
    fields="""
        projectname      string required
        stationcode      string required
        stationname      string required unique
        node             string required
        statecode        string required
        longitude        double
        latitude         double
        stationstartdate date required
        stationdepth_m   double
        samplingeffort   string required
        imcra            string
        imcra_pb         string
        managementregion string
    """,
    ranges={"longitude": (-180, 180), "latitude": (-90, 90)},
)

TABLES = (
    BGC_TRIP,
    BGC_PHYTO_RAW,
    BGC_PHYTO_CHANGELOG,
    BGC_ZOOP_RAW,
    BGC_ZOOP_CHANGELOG,
    BGC_CHEMISTRY,
    BGC_PICOPLANKTON,
    BGC_PICOPLANKTON_META,
    BGC_PIGMENTS,
    BGC_TSS,
    BGC_TSS_META,
    BGC_LFISH_SAMPLES,
    BGC_LFISH_COUNTRAW,
    ZOOPINFO,
    PHYTOINFO,
    BGC_STATIONINFO,
)
