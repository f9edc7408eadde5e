"""Names and settings of the season tables.

Everything in this file is a fixed value: the results are defined by these names, in this order.
"""

from __future__ import annotations

from statloom.functions.text import MISSING
from statloom.operators.features import key_weights
from statloom.operators.value_model import RoleModel

# --- fixed values: columns of the wide table, in order -----------------------------------------
TEXT = ["Player", "Nation", "Team", "Position"]
REQUIRED = [
    *TEXT, "Age",
    "Matches Played", "Starts", "Minutes", "Gls", "Ast", "crdY", "crdR", "xG", "xAG",
    "PrgC", "PrgP", "PrgR", "Gls per 90", "Ast per 90", "xG per 90", "xAG per 90",
    "GA90", "Save%", "CS%", "PK Save%",
    "SoT%", "SoT per 90", "G per Sh", "Dist",
    "Cmp", "Cmp%", "TotDist", "ShortCmp%", "MedCmp%", "LongCmp%", "KP", "Pass into 1_3", "PPA",
    "CrsPA", "SCA", "SCA90", "GCA", "GCA90",
    "Tkl", "TklW", "Deff Att", "Lost", "Blocks", "Sh", "Pass", "Int",
    "Touches", "Def Pen", "Def 3rd", "Mid 3rd", "Att 3rd", "Att Pen",
    "Take-Ons Att", "Succ%", "Tkld%", "Carries", "ProDist", "Carries 1_3", "CPA", "Mis", "Dis",
    "Rec", "Rec PrgR",
    "Fls", "Fld", "Off", "Crs", "Recov", "Aerl Won", "Aerl Lost", "Aerl Won%",
]
WHOLE = [
    "Matches Played", "Starts", "Minutes", "Gls", "Ast", "crdY", "crdR", "PrgC", "PrgP", "PrgR",
    "Cmp", "TotDist", "Tkl", "TklW", "Deff Att", "Lost", "Blocks", "Sh", "Pass", "Int",
    "Touches", "Def Pen", "Def 3rd", "Mid 3rd", "Att 3rd", "Att Pen", "Take-Ons Att",
    "Carries", "Carries 1_3", "CPA", "Mis", "Dis", "Rec", "Rec PrgR",
    "Fls", "Fld", "Off", "Crs", "Recov", "Aerl Won", "Aerl Lost",
]

# --- fixed values: page headers of each stat table and the names they get -----------------------
HEADERS = {
    "stats_standard": {
        "Unnamed: 1": "Player", "Unnamed: 2": "Nation", "Unnamed: 3": "Position",
        "Unnamed: 4": "Team", "Unnamed: 5": "Age",
        "Playing Time": "Matches Played", "Playing Time.1": "Starts", "Playing Time.2": "Minutes",
        "Performance": "Gls", "Performance.1": "Ast", "Performance.6": "crdY",
        "Performance.7": "crdR", "Expected": "xG", "Expected.2": "xAG",
        "Progression": "PrgC", "Progression.1": "PrgP", "Progression.2": "PrgR",
        "Per 90 Minutes": "Gls per 90", "Per 90 Minutes.1": "Ast per 90",
        "Per 90 Minutes.5": "xG per 90", "Per 90 Minutes.6": "xAG per 90",
    },
    "stats_keeper": {
        "Unnamed: 1": "Player", "Performance.1": "GA90", "Performance.4": "Save%",
        "Performance.9": "CS%", "Penalty Kicks.4": "PK Save%",
    },
    "stats_shooting": {
        "Unnamed: 1": "Player", "Standard.3": "SoT%", "Standard.5": "SoT per 90",
        "Standard.6": "G per Sh", "Standard.8": "Dist",
    },
    "stats_passing": {
        "Unnamed: 1": "Player", "Total": "Cmp", "Total.2": "Cmp%", "Total.3": "TotDist",
        "Short.2": "ShortCmp%", "Medium.2": "MedCmp%", "Long.2": "LongCmp%",
        "Unnamed: 26": "KP", "Unnamed: 27": "Pass into 1_3", "Unnamed: 28": "PPA",
        "Unnamed: 29": "CrsPA",
    },
    "stats_gca": {"Unnamed: 1": "Player", "SCA.1": "SCA90", "GCA.1": "GCA90"},
    "stats_defense": {
        "Unnamed: 1": "Player", "Tackles": "Tkl", "Tackles.1": "TklW",
        "Challenges.1": "Deff Att", "Challenges.3": "Lost",
        "Blocks": "Blocks", "Blocks.1": "Sh", "Blocks.2": "Pass", "Unnamed: 20": "Int",
    },
    "stats_possession": {
        "Unnamed: 1": "Player", "Touches": "Touches", "Touches.1": "Def Pen",
        "Touches.2": "Def 3rd", "Touches.3": "Mid 3rd", "Touches.4": "Att 3rd",
        "Touches.5": "Att Pen", "Take-Ons": "Take-Ons Att", "Take-Ons.2": "Succ%",
        "Take-Ons.4": "Tkld%", "Carries": "Carries", "Carries.2": "ProDist",
        "Carries.4": "Carries 1_3", "Carries.5": "CPA", "Carries.6": "Mis", "Carries.7": "Dis",
        "Receiving": "Rec", "Receiving.1": "Rec PrgR",
    },
    "stats_misc": {
        "Unnamed: 1": "Player", "Performance.3": "Fls", "Performance.4": "Fld",
        "Performance.5": "Off", "Performance.6": "Crs", "Performance.12": "Recov",
        "Aerial Duels": "Aerl Won", "Aerial Duels.1": "Aerl Lost",
        "Aerial Duels.2": "Aerl Won%",
    },
}

# --- fixed values: thresholds and lists of the analyses -----------------------------------------
MIN_MINUTES = 90
TRANSFER_MINUTES = 900
NEGATIVE = ["GA90", "crdY", "crdR", "Lost", "Mis", "Dis", "Fls", "Off", "Aerl Lost"]
PLOTTED = ["Gls per 90", "xG per 90", "SCA90", "TklW", "Blocks", "Int"]
NOT_CLUSTERED = [
    "GA90", "Save%", "CS%", "PK Save%", "SoT%", "SoT per 90", "G per Sh", "Dist",
]
SPECIAL_NAMES = {
    "Manuel Ugarte Ribeiro": "Manuel Ugarte",
    "Igor Júlio": "Igor",
    "Igor Thiago": "Thiago",
    "Felipe Morato": "Morato",
    "Nathan Wood-Gordon": "Nathan Wood",
    "Bobby Reid": "Bobby Cordova-Reid",
    "J. Philogene": "Jaden Philogene Bidace",
}
ROLES = [
    RoleModel(
        "Goalkeeper", "GK",
        ["Save%", "CS%", "GA90", "Minutes", "Age", "PK Save%"],
        ["Team", "Nation"],
        key_weights(["Save%", "CS%", "PK Save%"]),
    ),
    RoleModel(
        "Defender", "DF",
        ["Tkl", "TklW", "Int", "Blocks", "Recov", "Minutes", "Age", "Aerl Won%", "Aerl Won",
         "Cmp", "Cmp%", "PrgP", "LongCmp%", "Carries", "Touches", "Dis", "Mis"],
        ["Team", "Nation"],
        key_weights(["Tkl", "TklW", "Int", "Blocks", "Aerl Won%", "Aerl Won", "Recov"]),
    ),
    RoleModel(
        "Midfielder", "MF",
        ["Cmp%", "KP", "PPA", "PrgP", "Tkl", "Ast", "SCA", "Touches", "Minutes", "Age",
         "Pass into 1_3", "xAG", "Carries 1_3", "ProDist", "Rec", "Mis", "Dis"],
        ["Team", "Nation"],
        key_weights(["KP", "PPA", "PrgP", "SCA", "xAG", "Pass into 1_3", "Carries 1_3"]),
    ),
    RoleModel(
        "Forward", "FW",
        ["Gls", "Ast", "Gls per 90", "xG per 90", "SoT%", "G per Sh", "SCA90", "GCA90",
         "PrgC", "Carries 1_3", "Aerl Won%", "Age", "Minutes"],
        ["Team"],
        key_weights(["Gls", "Ast", "Gls per 90", "xG per 90", "SCA90", "GCA90"]),
    ),
]

# --- derived ------------------------------------------------------------------------------------
STATS = [c for c in REQUIRED if c not in TEXT]
DECIMAL = [c for c in STATS if c not in WHOLE]
CLUSTERED = [c for c in STATS if c not in NOT_CLUSTERED]
#: Schema of the wide table as a file.
WIDE_SCHEMA = ", ".join(
    f"`{c}` " + ("string" if c in TEXT else "bigint" if c in WHOLE else "double") for c in REQUIRED
)
UNKNOWN = "Unknown"
