"""Fixed values that must equal the studied project's literals."""

# Party orientation by party id (21 pairs; 7 left, 5 right, 9 center).
PARTY_ORIENTATION = [
    (1, "left"), (2, "right"), (3, "center"), (4, "right"), (5, "center"),
    (6, "left"), (7, "center"), (8, "left"), (9, "center"), (10, "right"),
    (11, "right"), (12, "left"), (13, "center"), (14, "center"), (15, "left"),
    (16, "left"), (17, "center"), (18, "right"), (19, "center"), (20, "center"),
    (21, "left"),
]

# Region pool for countries without a region (one spelling).
REGIONS = ["Center", "East", "South", "North", "West"]

# Orientation pool for parties without an orientation.
ORIENTATIONS = ["Center", "Left", "Right"]

# Generated people (first names by gender, last names, titles).
MALE_NAMES = ["Carlos", "João", "Pedro", "Rui", "Miguel", "Tiago", "André", "Manuel"]
FEMALE_NAMES = ["Maria", "Ana", "Inês", "Beatriz", "Sofia", "Cláudia", "Joana", "Marta"]
LAST_NAMES = ["Silva", "Santos", "Ferreira", "Pereira", "Oliveira", "Costa", "Rodrigues",
              "Martins", "Gomes", "Lopes"]
TITLES_MALE = ["Dr.", "Eng.", "Prof.", "Sr."]
TITLES_FEMALE = ["Dra.", "Eng.ª", "Prof.ª", "Sra."]
BIRTH_YEARS = (1950, 2000)

# Start of the generated validity ranges and their step.
RANGE_START = "2020-01-01 00:00:00"
RANGE_STEP_MINUTES = 60

# Election-night window (spread) and hourly slots.
SPREAD_HOURS = (18, 23)
SLOT_HOURS = (18, 22)

# Fixed value: degenerate dimension values of the fact.
RESULT_OFFICIAL = "official"
RESULT_PRELIMINARY = "preliminary"
