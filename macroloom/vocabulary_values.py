"""Fixed values of the bulk-archive vocabulary, and the small frames built from them.

The area map has no table here: it is derived from data by ``macroloom.plans.vocabulary`` and
handed to the pipelines as a frame (legacy, code).
"""

from pyspark.sql import DataFrame, SparkSession

from macroloom.schema import LABEL_SCHEMA, UNIT_MAP_SCHEMA
from macroloom.work import inline

# Concept, unit letter, unit.
UNITS = [
    ("BCA", "P", "USD"),
    ("BCA_NGDPD", "K", "PT"),
    ("BF", "P", "USD"),
    ("BFD", "P", "USD"),
    ("BFF", "P", "USD"),
    ("BFO", "P", "USD"),
    ("BFP", "P", "USD"),
    ("BFRA", "P", "USD"),
    ("BM", "P", "USD"),
    ("BX", "P", "USD"),
    ("D", "P", "USD"),
    ("DS", "P", "USD"),
    ("DSI", "P", "USD"),
    ("DSI_BX", "J", "PT"),
    ("DSI_NGDPD", "K", "PT"),
    ("DSP", "P", "USD"),
    ("DSP_BX", "J", "PT"),
    ("DSP_NGDPD", "K", "PT"),
    ("DS_BX", "J", "PT"),
    ("DS_NGDPD", "K", "PT"),
    ("D_BX", "J", "PT"),
    ("D_NGDPD", "K", "PT"),
    ("FLIBOR3", "G", "PT"),
    ("FLIBOR6", "G", "PT"),
    ("GGR", "E", "XDC"),
    ("GGR_NGDP", "K", "PT"),
    ("GGSB", "E", "XDC"),
    ("GGSB_NPGDP", "L", "PT"),
    ("GGX", "E", "XDC"),
    ("GGXCNL", "E", "XDC"),
    ("GGXCNL_NGDP", "K", "PT"),
    ("GGXONLB", "E", "XDC"),
    ("GGXONLB_NGDP", "K", "PT"),
    ("GGXWDG", "E", "XDC"),
    ("GGXWDG_NGDP", "K", "PT"),
    ("GGXWDN", "E", "XDC"),
    ("GGXWDN_NGDP", "K", "PT"),
    ("GGX_NGDP", "K", "PT"),
    ("LE", "C", "IX"),
    ("LE", "N", "PE"),
    ("LP", "N", "PE"),
    ("LUR", "M", "PT"),
    ("NGAP_NPGDP", "L", "PT"),
    ("NGDP", "E", "XDC"),
    ("NGDPD", "P", "USD"),
    ("NGDPDPC", "P", "USD"),
    ("NGDPPC", "E", "XDC"),
    ("NGDPRPC", "E", "XDC"),
    ("NGDPRPPPPCPCH", "V", "PT"),
    ("NGDP_D", "B", "IX"),
    ("NGDP_D", "C", "IX"),
    ("NGDP_FY", "E", "XDC"),
    ("NGDP_R", "E", "XDC"),
    ("NGDP_RPCH", "H", "PT"),
    ("NGDP_RPCHMK", "I", "PT"),
    ("NGSD_NGDP", "K", "PT"),
    ("NID_NGDP", "K", "PT"),
    ("PALLFNFW", "D", "IX"),
    ("PALLFNFW", "U", "IX"),
    ("PALUM", "P", "USDPMT"),
    ("PBANSOP", "P", "USDPMT"),
    ("PBARL", "P", "USDPMT"),
    ("PBEEF", "O", "USCPP"),
    ("PBEVEW", "D", "IX"),
    ("PBEVEW", "U", "IX"),
    ("PCEREW", "D", "IX"),
    ("PCEREW", "U", "IX"),
    ("PCOALAU", "P", "USDPMT"),
    ("PCOALSA", "P", "USDPMT"),
    ("PCOALW", "D", "IX"),
    ("PCOALW", "U", "IX"),
    ("PCOCO", "P", "USDPMT"),
    ("PCOFFOTM", "O", "USCPP"),
    ("PCOFFROB", "O", "USCPP"),
    ("PCOFFW", "D", "IX"),
    ("PCOFFW", "U", "IX"),
    ("PCOPP", "P", "USDPMT"),
    ("PCOTTIND", "O", "USCPP"),
    ("PCPI", "B", "IX"),
    ("PCPIE", "B", "IX"),
    ("PCPIEPCH", "H", "PT"),
    ("PCPIPCH", "H", "PT"),
    ("PFANDBW", "D", "IX"),
    ("PFANDBW", "U", "IX"),
    ("PFISH", "P", "USDPMT"),
    ("PFOODW", "D", "IX"),
    ("PFOODW", "U", "IX"),
    ("PGNUTS", "P", "USDPMT"),
    ("PHARDW", "D", "IX"),
    ("PHARDW", "U", "IX"),
    ("PHIDE", "O", "USCPP"),
    ("PINDUW", "D", "IX"),
    ("PINDUW", "U", "IX"),
    ("PIORECR", "P", "USDPMT"),
    ("PLAMB", "O", "USCPP"),
    ("PLEAD", "P", "USDPMT"),
    ("PLOGORE", "P", "USD_PCM"),
    ("PLOGSK", "P", "USD_PCM"),
    ("PMAIZMT", "P", "USDPMT"),
    ("PMEATW", "D", "IX"),
    ("PMEATW", "U", "IX"),
    ("PMETAW", "D", "IX"),
    ("PMETAW", "U", "IX"),
    ("PNFUELW", "D", "IX"),
    ("PNFUELW", "U", "IX"),
    ("PNGASEU", "P", "USDBTU"),
    ("PNGASJP", "P", "USDBTU"),
    ("PNGASUS", "P", "USDPMT"),
    ("PNGASW", "D", "IX"),
    ("PNGASW", "U", "IX"),
    ("PNICK", "P", "USDPMT"),
    ("PNRGW", "D", "IX"),
    ("PNRGW", "U", "IX"),
    ("POILAPSP", "P", "USD_BBL"),
    ("POILAPSPW", "D", "IX"),
    ("POILAPSPW", "U", "IX"),
    ("POILBRE", "P", "USD_BBL"),
    ("POILDUB", "P", "USD_BBL"),
    ("POILWTI", "P", "USD_BBL"),
    ("POLVOIL", "P", "USDPMT"),
    ("PORANG", "P", "USDPMT"),
    ("PPOIL", "P", "USDPMT"),
    ("PPORK", "O", "USCPP"),
    ("PPOULT", "O", "USCPP"),
    ("PPPSH", "G", "PT"),
    ("PRAWMW", "D", "IX"),
    ("PRAWMW", "U", "IX"),
    ("PRICENPQ", "P", "USDPMT"),
    ("PROIL", "P", "USDPMT"),
    ("PRUBB", "O", "USCPP"),
    ("PSALM", "P", "USDPK"),
    ("PSAWMAL", "P", "USD_PCM"),
    ("PSAWORE", "P", "USD_PCM"),
    ("PSEAFW", "D", "IX"),
    ("PSEAFW", "U", "IX"),
    ("PSHRI", "P", "USDPK"),
    ("PSMEA", "P", "USDPMT"),
    ("PSOFTW", "D", "IX"),
    ("PSOFTW", "U", "IX"),
    ("PSOIL", "P", "USDPMT"),
    ("PSOYB", "P", "USDPMT"),
    ("PSUGAISA", "O", "USCPP"),
    ("PSUGAUSA", "O", "USCPP"),
    ("PSUGAW", "D", "IX"),
    ("PSUGAW", "U", "IX"),
    ("PSUNO", "P", "USDPMT"),
    ("PTEA", "O", "USCPL"),
    ("PTIMBW", "D", "IX"),
    ("PTIMBW", "U", "IX"),
    ("PTIN", "P", "USDPMT"),
    ("PURAN", "P", "USDPP"),
    ("PVOILW", "D", "IX"),
    ("PVOILW", "U", "IX"),
    ("PWHEAMT", "P", "USDPMT"),
    ("PWOOLC", "O", "USCPL"),
    ("PWOOLF", "O", "USCPL"),
    ("PWOOLW", "D", "IX"),
    ("PWOOLW", "U", "IX"),
    ("PZINC", "P", "USDPMT"),
    ("TMG_RPCH", "H", "PT"),
    ("TM_RPCH", "H", "PT"),
    ("TRADEPCH", "H", "PT"),
    ("TTPCH", "H", "PT"),
    ("TTTPCH", "H", "PT"),
    ("TXGM_D", "R", "IX"),
    ("TXGM_DPCH", "Q", "PT"),
    ("TXG_RPCH", "H", "PT"),
    ("TX_RPCH", "H", "PT"),
]

# Fixed values: (concept, unit letter) pairs that deliberately have no unit.
PAIRS_WITHOUT_UNIT = [
    ("NGDPRPPPPC", "S"),
    ("PPPEX", "F"),
    ("PPPGDP", "T"),
    ("PPPPC", "T"),
    ("PSUGAEEC", "O"),
]

# Aggregates that only the bulk archive has, and their labels.
BULK_ONLY_AREAS = {
    406: "Middle East and North Africa",
    440: "Middle East, North Africa, Afghanistan, and Pakistan",
    511: "ASEAN-5",
    901: "Commonwealth of Independent States",
}

# Units decided by hand where neither values nor labels settle them.
UNIT_DECISIONS = [
    ("LE", "N", "PE"),
    ("LP", "N", "PE"),
    ("NGDPRPPPPC", "S", None),
    ("PPPEX", "F", None),
    ("PPPGDP", "T", None),
    ("PPPPC", "T", None),
    ("PSUGAEEC", "O", None),
]


def unit_map(spark: SparkSession) -> DataFrame:
    """(concept, letter, unit), the pairs without a unit included with a null."""
    return inline(spark, [*UNITS, *((*pair, None) for pair in PAIRS_WITHOUT_UNIT)], UNIT_MAP_SCHEMA)


def bulk_only_labels(spark: SparkSession) -> DataFrame:
    """(code, label) of the aggregates only the bulk archive has."""
    return inline(spark, [(f"G{k:03d}", v) for k, v in BULK_ONLY_AREAS.items()], LABEL_SCHEMA)
