"""Thresholds and vocabularies of genome annotation. All are fixed values: results depend on them."""

# similarity gates
PSC_MIN_IDENTITY, PSC_MAX_EVALUE = 50.0, 1e-6
VF_MAX_EVALUE, VF_MIN_QCOV, VF_MIN_TCOV, VF_MIN_IDENTITY = 1e-10, 0.80, 0.70, 90.0
PLASMID_MIN_IDENTITY, PLASMID_MIN_TCOV = 80.0, 0.60
SPECIES_IDENTITY, GENUS_IDENTITY = 98.7, 94.5
AMR_MIN_IDENTITY = 90.0
ORIT_BASE = {"evalue": 1e-5, "pident": 70.0, "tcov": 0.50, "alnlen": 25}
ORIT_ALONE = {"evalue": 1e-8, "pident": 80.0, "tcov": 0.60, "alnlen": 25}
ORIT_WINDOW = 10_000
RELAXASE_MAX_EVALUE = 1e-5
ATTC_MAX_EVALUE, ATTC_WINDOW, CALIN_MIN = 1e-3, 4_000, 2
PROPHAGE_GAP, PROPHAGE_MIN_CLASSES, PROPHAGE_INTACT = 10_000, 3, 6
NCRNA_MAX_EVALUE, RRNA_MIN_COVERAGE = 1e-4, 0.30
SORF_MIN_AA, SORF_MAX_AA, SORF_MAX_EVALUE, SORF_QCOV, SORF_TCOV, SORF_PSC_EVALUE = 8, 50, 1e-3, 0.8, 0.7, 1e-6
OVERLAP_FRACTION = 0.5
CDS_SINGLE_MIN = 20_000

# disrupted genes
SPLIT_PIECE_AA, SPLIT_UNION, SPLIT_SUM, SPLIT_QGAP, SPLIT_SPAN, SPLIT_OVERLAP, SPLIT_TGAP = 15, 0.5, 1.25, 300, 1.5, 20, 60
PSEUDO_MIN_TLEN, PSEUDO_MAX_EVALUE = 60, 1e-10
TRUNC_MIN, TRUNC_MAX, TRUNC_END, TRUNC_RATIO = 0.20, 0.85, 10, 0.85
INTERGENIC_MIN, INTERGENIC_TCOV = 150, 0.40
EDGE = 3
REFLEN_MIN_AA, REFLEN_MIN_REF, REFLEN_RATIO = 40, 60, 0.55
LOCALIZATION_MIN, GENE_SCORE_NOTE = 0.7, 0.1
START_OVERHANG, START_SCORE, START_TAIL, START_COVERAGE, START_MIN_AA = (12, 60), 25.0, 5, 0.70, 40
QUERY_UP, QUERY_DOWN, QUERY_MIN = 60, 450, 30
LEGACY_GAP, LEGACY_OVERLAP, LEGACY_RATIO, LEGACY_SHORTFALL, LEGACY_MIN_REF, LEGACY_SHORT = 60, 30, 0.8, 25, 50, 150
FRAMESHIFT_OVERLAP, READTHROUGH_CODONS, READTHROUGH_CAP = (1, 8), 80, 5000

#: Search settings: highest E-value, most targets a query, letters of a seed where it isn't the default.
SEARCH = {"psc": (1e-6, 25, None), "vfdb": (1e-10, 25, None), "disruption": (1e-5, 300, None), "plasmid": (1e-10, 300, None), "species": (1e-20, 50, None), "orit": (1e-4, 500, 9), "amr_variants": (1e-10, 300, None)}

# sequence
STARTS, STOPS = ("ATG", "GTG", "TTG"), ("TAA", "TAG", "TGA")
AMINO_ACIDS = "ARNDCQEGHILKMFPSTWYV"
HMM_ALPHABET = "ACDEFGHIKLMNPQRSTVWY"

# vocabularies
COG_LETTERS = "JAKLBDYVTMNZWUOXCGEFHIPQRS"
PLACEHOLDERS = ("", "hypothetical protein", "uncharacterized protein", "putative protein", "protein of unknown function")
TAXA_ROOTS = (2, 2157, 10239)
#: kind: (feature type of the flat files, priority when RNAs and CDS overlap, takes part in that, has a gene parent)
KINDS = {
    "Cds": ("CDS", 1, True, True), "Trna": ("tRNA", 3, True, True), "Tmrna": ("tmRNA", 3, True, True), "Rrna": ("rRNA", 4, True, True),
    "Ncrna": ("ncRNA", 2, True, True), "Crispr": ("repeat_region", 0, False, False), "IsElement": ("mobile_genetic_element", 0, False, False),
    "OriC": ("origin_of_replication", 0, False, False), "AssemblyGap": ("assembly_gap", 0, False, False), "TandemRepeat": ("repeat_region", 0, False, False),
    "Prophage": ("region", 0, False, False), "Integron": ("mobile_genetic_element", 0, False, False), "OriT": ("origin_of_transfer", 0, False, False),
    "RegulatoryRegion": ("regulatory_region", 2, False, False),
}
#: Single-copy ribosomal-protein markers of genome quality.
MARKERS = (
    "L1 L2 L3 L4 L5 L6 L9 L10 L11 L13 L14 L15 L16 L17 L18 L19 L20 L21 L22 L23 L24 L27 L28 L29 L30 L32 L35 "
    "S2 S3 S4 S5 S6 S7 S8 S9 S10 S11 S12 S13 S15 S16 S17 S18 S19 S20"
).split()
SSU_FAMILIES = ("RF00177", "RF01959", "RF01960", "RF02542")
#: Phage hallmark classes by family accession, and by model name where a profile has no accession.
HALLMARK_ACCESSIONS = {
    "terminase": "PF03237 PF03354 PF03592 PF04466 PF05876", "portal": "PF04860 PF05136", "capsid": "PF03864 PF04233 PF05065", "protease": "PF04586",
    "tail": "PF03906 PF04865 PF04984 PF04985 PF05100 PF06199 PF10145 PF10618", "integrase": "PF00589 PF07508", "lysis": "PF00959 PF05105 PF11860 PF16080",
}
HALLMARK_NAMES = {
    "terminase": "TerL_ATPase Terminase_3 Terminase_6N GpA_ATPase Terminase_2", "portal": "Phage_portal Phage_portal_2", "capsid": "Phage_capsid Phage_cap_E Phage_Mu_F",
    "protease": "Peptidase_S78", "tail": "Phage_sheath_1 Baseplate_J Tail_tube Phage_tail_2 Phage_tube Phage_T7_tail Phage_tail_L PhageMin_Tail",
    "integrase": "Phage_integrase Recombinase", "lysis": "Phage_lysozyme Muramidase Phage_holin_4_1 Phage_holin_2_3",
}
HALLMARK_CORE = ("terminase", "portal", "capsid")
#: Relaxase families by accession.
MOB_ACCESSIONS = {"PF01076": "MOBV", "PF03389": "MOBQ", "PF03432": "MOBF", "PF05713": "MOBC", "PF07514": "MOBF", "PF13814": "relaxase (Replic_Relax)"}
RRNA_PRODUCTS = {
    "SSU_rRNA_bacteria": "16S ribosomal RNA", "SSU_rRNA_archaea": "16S ribosomal RNA", "LSU_rRNA_bacteria": "23S ribosomal RNA", "LSU_rRNA_archaea": "23S ribosomal RNA",
    "5S_rRNA": "5S ribosomal RNA", "5_8S_rRNA": "5.8S ribosomal RNA", "SSU_rRNA_eukarya": "18S ribosomal RNA", "LSU_rRNA_eukarya": "28S ribosomal RNA",
}
RRNA_PREFIXES = (("SSU_rRNA", "16S ribosomal RNA"), ("LSU_rRNA", "23S ribosomal RNA"), ("5_8S", "5.8S ribosomal RNA"), ("5S", "5S ribosomal RNA"))
UNDETERMINED_TRNA = ("", "undet", "pseudo", "sup", "xxx")
