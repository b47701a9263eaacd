"""Published names of laboratory columns, stated for the SQL on its own."""

CHEMISTRY = {
    "salinity_psu": "Salinity",
    "salinity_flag": "Salinity_flag",
    "dic_umolkg": "DIC_umolkg",
    "carbon_flag": "DIC_flag",
    "talkalinity_umolkg": "Alkalinity_umolkg",
    "alkalinity_flag": "Alkalinity_flag",
    "oxygen_umoll": "Oxygen_umolL",
    "oxygen_flag": "Oxygen_flag",
    "ammonium_umoll": "Ammonium_umolL",
    "ammonium_flag": "Ammonium_flag",
    "nitrate_umoll": "Nitrate_umolL",
    "nitrate_flag": "Nitrate_flag",
    "nitrite_umoll": "Nitrite_umolL",
    "nitrite_flag": "Nitrite_flag",
    "phosphate_umoll": "Phosphate_umolL",
    "phosphate_flag": "Phosphate_flag",
    "silicate_umoll": "Silicate_umolL",
    "silicate_flag": "Silicate_flag",
}

MICROBIOME = {
    "microbiomesample_id": "AustralianMicrobiomeId",
}

PIGMENTS = {
    "allo": "Allo_mgm3",
    "alpha_beta_car": "AlphaBetaCar_mgm3",
    "anth": "Anth_mgm3",
    "asta": "Asta_mgm3",
    "beta_beta_car": "BetaBetaCar_mgm3",
    "beta_epi_car": "BetaEpiCar_mgm3",
    "but_fuco": "Butfuco_mgm3",
    "cantha": "Cantha_mgm3",
    "cphl_a": "CphlA_mgm3",
    "cphl_b": "CphlB_mgm3",
    "cphl_c1": "CphlC1_mgm3",
    "cphl_c2": "CphlC2_mgm3",
    "cphl_c3": "CphlC3_mgm3",
    "cphl_c1c2": "CphlC1C2_mgm3",
    "cphlide_a": "CphlideA_mgm3",
    "diadchr": "Diadchr_mgm3",
    "diadino": "Diadino_mgm3",
    "diato": "Diato_mgm3",
    "dino": "Dino_mgm3",
    "dv_cphl_a_and_cphl_a": "DvCphlA+CphlA_mgm3",
    "dv_cphl_a": "DvCphlA_mgm3",
    "dv_cphl_b_and_cphl_b": "DvCphlB+CphlB_mgm3",
    "dv_cphl_b": "DvCphlB_mgm3",
    "echin": "Echin_mgm3",
    "fuco": "Fuco_mgm3",
    "gyro": "Gyro_mgm3",
    "hex_fuco": "Hexfuco_mgm3",
    "keto_hex_fuco": "Ketohexfuco_mgm3",
    "lut": "Lut_mgm3",
    "lyco": "Lyco_mgm3",
    "mg_dvp": "MgDvp_mgm3",
    "neo": "Neo_mgm3",
    "perid": "Perid_mgm3",
    "phide_a": "PhideA_mgm3",
    "phytin_a": "PhytinA_mgm3",
    "phytin_b": "PhytinB_mgm3",
    "pras": "Pras_mgm3",
    "pyrophide_a": "PyrophideA_mgm3",
    "pyrophytin_a": "PyrophytinA_mgm3",
    "viola": "Viola_mgm3",
    "zea": "Zea_mgm3",
    "pigments_flag": "Pigments_flag",
}

PICOPLANKTON_REPLICATES = {
    "replicate": "Replicate",
    "prochlorococcus_cellsml": "Prochlorococcus_cellsmL",
    "prochlorococcus_flag": "Prochlorococcus_flag",
    "synecochoccus_cellsml": "Synechococcus_cellsmL",
    "synecochoccus_flag": "Synechococcus_flag",
    "picoeukaryotes_cellsml": "Picoeukaryotes_cellsmL",
    "picoeukaryotes_flag": "Picoeukaryotes_flag",
    "bacteria_cellsml": "Bacteria_cellsmL",
    "bacteria_flag": "Bacteria_flag",
    "virus_cellsml": "Virus_cellsmL",
    "virus_flag": "Virus_flag",
    "pico_comments": "PicoplankComments",
    "analysis_location": "AnalysisLocation",
    "analysis_date": "AnalysisDate",
    "analyst_name": "AnalystName",
    "temp_thawed_degc": "TempThawed_DegC",
    "internal_standard": "InternalStandard",
    "instrument_brand_model": "InstrumentBrandModel",
    "instrument_serial_number": "InstrumentSerialNumber",
    "laser_nm": "Laser_nm",
    "mode_type": "ModeType",
    "analysis_volume_ul": "AnalysisVolume_uL",
    "flow_rate_ul_per_min": "Flowrate_uLmin",
    "analysis_time_minutes": "AnalysisTime_min",
    "batch_comments": "BatchComments",
}

SOLIDS_REPLICATES = {
    "replicate": "Replicate",
    "organicfraction_mgl": "TSSorganic_mgL",
    "inorganicfraction_mgl": "TSSinorganic_mgL",
    "tss_mgl": "TSS_mgL",
    "tss_flag": "TSSall_flag",
    "tss_comments": "TSScomments",
    "blankadjustavailable": "BlankAdjustAvailable",
}

SOLIDS = {
    "organicfraction_mgl": "TSSorganic_mgL",
    "inorganicfraction_mgl": "TSSinorganic_mgL",
    "tss_mgl": "TSS_mgL",
    "tss_flag": "TSSall_flag",
}

PICOPLANKTON = {
    "prochlorococcus_cellsml": "Prochlorococcus_cellsmL",
    "prochlorococcus_flag": "Prochlorococcus_flag",
    "synecochoccus_cellsml": "Synechococcus_cellsmL",
    "synecochoccus_flag": "Synechococcus_flag",
    "picoeukaryotes_cellsml": "Picoeukaryotes_cellsmL",
    "picoeukaryotes_flag": "Picoeukaryotes_flag",
}

# published mean: (value, flag)
CHEMISTRY_MEANS = {
    "Silicate_umolL": ("silicate_umoll", "silicate_flag"),
    "Phosphate_umolL": ("phosphate_umoll", "phosphate_flag"),
    "Ammonium_umolL": ("ammonium_umoll", "ammonium_flag"),
    "Nitrate_umolL": ("nitrate_umoll", "nitrate_flag"),
    "Nitrite_umolL": ("nitrite_umoll", "nitrite_flag"),
    "Oxygen_umolL": ("oxygen_umoll", "oxygen_flag"),
    "DIC_umolkg": ("dic_umolkg", "carbon_flag"),
    "Alkalinity_umolkg": ("talkalinity_umolkg", "alkalinity_flag"),
    "Salinity": ("salinity_psu", "salinity_flag"),
}
