"""Names, encodings and constants of the domain, which results depend on."""

# Residue names in index order, hydropathy values and polarity classes.
RESIDUES = ["CYS", "HIS", "ASN", "GLN", "SER", "THR", "TYR", "TRP", "ALA", "PHE", "GLY", "ILE", "VAL", "MET", "PRO", "LEU", "GLU", "ASP", "LYS", "ARG"]
HYDROPATHY = {
    "CYS": 2.5, "HIS": -3.2, "ASN": -3.5, "GLN": -3.5, "SER": -0.8, "THR": -0.7, "TYR": -1.3, "TRP": -0.9, "ALA": 1.8, "PHE": 2.8,
    "GLY": -0.4, "ILE": 4.5, "VAL": 4.2, "MET": 1.9, "PRO": -1.6, "LEU": 3.8, "GLU": -3.5, "ASP": -3.5, "LYS": -3.9, "ARG": -4.5,
}
POLARITY = ["apolar", "polar", "neg_charged", "pos_charged"]
POLAR = ["CYS", "HIS", "ASN", "GLN", "SER", "THR", "TYR", "TRP"]
APOLAR = ["ALA", "PHE", "GLY", "ILE", "VAL", "MET", "PRO", "LEU"]
NEGATIVE = ["GLU", "ASP"]
POSITIVE = ["LYS", "ARG"]
#: Residues accepted as nodes besides the twenty.
ALSO_VALID = ["ASX", "SEC", "GLX"]
# Atom names in index order.
ATOMS = [
    "N", "CA", "C", "O", "CB", "CG", "CG1", "CG2", "CD", "CD1", "CD2", "CE", "CE1", "CE2", "CE3", "CZ", "CZ2", "CZ3",
    "CH2", "ND1", "ND2", "NE", "NE1", "NE2", "NH1", "NH2", "NZ", "OD1", "OD2", "OE1", "OE2", "OG", "OG1", "OH", "SD", "SG",
]
# Region labels in index order, and numbering ranges of the loops.
REGIONS = ["FR", "L1", "L2", "L3", "H1", "H2", "H3", "CONST", "AG"]
LOOPS = {"1": (27, 38), "2": (56, 65), "3": (105, 117)}
# One-letter codes.
ONE_LETTER = {
    "ALA": "A", "ARG": "R", "ASN": "N", "ASP": "D", "CYS": "C", "GLU": "E", "GLN": "Q", "GLY": "G", "HIS": "H", "ILE": "I",
    "LEU": "L", "LYS": "K", "MET": "M", "PHE": "F", "PRO": "P", "SER": "S", "THR": "T", "TRP": "W", "TYR": "Y", "VAL": "V", "MSE": "M",
}
# Energies and distances (kcal/mol, angstrom).
COULOMB = 332.0636
COVALENT, SAME_13, SAME_14 = 2.1, 3.6, 4.2
# The contact-based affinity model of Vangone and Bonvin (2015): contact classes, surface shares, intercept; gas constant.
AFFINITY = {"CC": -0.09459, "CA": -0.10007, "PP": 0.19577, "PA": -0.22671, "apolar": 0.18681, "charged": 0.13810, "constant": -15.9433}
GAS = 0.0019858775
# Contact character of residues in that model.
CHARACTER = {
    "charged": ["ARG", "LYS", "ASP", "GLU"],
    "polar": ["ASN", "GLN", "HIS", "SER", "THR", "CYS", "TYR", "TRP"],
    "apolar": ["ALA", "GLY", "ILE", "LEU", "MET", "PHE", "PRO", "VAL"],
}
# Van der Waals radii by element (Bondi 1964, hydrogen as revised), angstrom.
RADII = {"H": 1.1, "C": 1.7, "N": 1.55, "O": 1.52, "P": 1.8, "S": 1.8}
# Accessible areas of residues in Ala-X-Ala, square angstrom, by which the affinity model's relative areas are taken.
LARGEST_AREA = {
    "ALA": 107.95, "ARG": 238.76, "ASN": 143.94, "ASP": 140.39, "CYS": 134.28, "GLU": 172.25, "GLN": 178.50, "GLY": 80.10, "HIS": 182.88, "ILE": 175.12,
    "LEU": 178.63, "LYS": 200.81, "MET": 194.15, "PHE": 199.48, "PRO": 136.13, "SER": 116.50, "THR": 139.27, "TRP": 249.36, "TYR": 212.76, "VAL": 151.44,
}
