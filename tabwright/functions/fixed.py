"""Fixed values that must equal the reference's for the same results.

Taken as they are, in their natural order; the names below say what each is.  A missing bin
(group sizes 9 and 10) means no value; the ticket digits are the first run of digits.
"""

# FIXED VALUES
CABIN_CODES = {"A": 0, "B": 1, "C": 2, "D": 3, "E": 4, "F": 5, "G": 6, "T": 7, "M": 8}
SEX_CODES = {"male": 0, "female": 1}
PORT_CODES = {"S": 0, "C": 1, "Q": 2}
RARE_TITLES = ["Don", "Rev", "Dr", "Mme", "Ms", "Major", "Lady", "Sir", "Mlle", "Col", "Capt",
               "Countess", "Jonkheer"]
TITLE_CODES = {"Mr": 0, "Miss": 1, "Mrs": 2, "Master": 3, "Rare": 4}
TITLE_DEFAULT = 0
MISSING_CABIN = "M"
FAMILY_SIZE_BINS = [(1, 1, 0), (2, 4, 1), (5, 7, 2), (8, None, 3)]
AGE_CLIP = (0.0, 80.0)
CHILD_AGE = 16
TITLE_PATTERN = r" ([A-Za-z]+)\."
DIGITS_PATTERN = r"([0-9]+)"
RULE_REWRITES = {0.0: {"sex": 0, "age": 28.0, "title": 0}, 1.0: {"sex": 1, "age": 5.0, "title": 1}}
MIXUP = {"alpha": 0.1, "num": 350, "seed": 622}
