"""Fixed values of the survey: column names, answer texts, labels and cuts.

Nothing here is logic.  The texts have to match the questionnaire exactly
(including its mix of ASCII and U+2019 apostrophes), because answers are
compared without trimming or case folding.
"""

# --- fixed values: columns kept from the raw export --------------------------
KEY = "ResponseId"

SURVEY_COLUMNS = [
    "ResponseId", "MainBranch", "Age", "EdLevel", "Employment",
    "WorkExp", "YearsCode", "DevType", "OrgSize", "ICorPM",
    "RemoteWork", "Country", "Industry", "ConvertedCompYearly", "JobSat",
    "AIThreat", "SOFriction",
    "AISelect", "AISent", "AIAcc", "AIComplex",
    "AIToolCurrently partially AI", "AIToolCurrently mostly AI",
    "AIToolPlan to partially use AI", "AIToolPlan to mostly use AI",
    "AIToolDon't plan to use AI for this task",
    "AIFrustration", "AIExplain",
    "AIAgents", "AIAgentChange", "AIAgent_Uses", "AgentUsesGeneral",
    "AIModelsHaveWorkedWith", "DevEnvsHaveWorkedWith",
]

# --- fixed values: missing answers -------------------------------------------
NULL_TOKEN = "NA"
UNKNOWN = "Unknown"
NO_PROBLEMS_GIVEN = "None reported"

FILL_DEFAULTS = {
    "AISelect": UNKNOWN,
    "AISent": UNKNOWN,
    "AIAcc": UNKNOWN,
    "AIComplex": UNKNOWN,
    "AIFrustration": NO_PROBLEMS_GIVEN,
    "AIThreat": UNKNOWN,
    "SOFriction": UNKNOWN,
    "AIAgents": UNKNOWN,
    "DevType": UNKNOWN,
    "Country": UNKNOWN,
    "Industry": UNKNOWN,
    "RemoteWork": UNKNOWN,
}

# --- fixed values: points per answer -----------------------------------------
USAGE_POINTS = {
    "Yes, I use AI tools daily": 5,
    "Yes, I use AI tools weekly": 4,
    "Yes, I use AI tools monthly or infrequently": 3,
    "No, but I plan to soon": 2,
    "No, and I don't plan to": 1,
}
AGENT_POINTS = {
    "Yes, I use AI agents at work daily": 5,
    "Yes, I use AI agents at work weekly": 4,
    "Yes, I use AI agents at work monthly or infrequently": 3,
    "No, I use AI exclusively in copilot/autocomplete mode": 2,
    "No, but I plan to": 1,
    "No, and I don't plan to": 0,
}
ACCURACY_POINTS = {
    "Highly trust": 5,
    "Somewhat trust": 4,
    "Neither trust nor distrust": 3,
    "Somewhat distrust": 2,
    "Highly distrust": 1,
}
COMPLEX_POINTS = {
    "Very well at handling complex tasks": 5,
    "Good, but not great at handling complex tasks": 4,
    "Neither good or bad at handling complex tasks": 3,
    "Bad at handling complex tasks": 2,
    "Very poor at handling complex tasks": 1,
}
SENTIMENT_POINTS = {
    "Very favorable": 5,
    "Favorable": 4,
    "Indifferent": 3,
    "Unfavorable": 2,
    "Very unfavorable": 1,
}
THREAT_POINTS = {
    "Yes": 1.0,
    "I'm not sure": 0.5,
}
YEARS_EDGE_PHRASES = {
    "Less than 1 year": 0.0,
    "More than 50 years": 51.0,
}
# Spelled with U+2019, unlike every other vocabulary above.
NOT_A_PROBLEM = [
    "I haven’t encountered any problems",
    "I don’t use AI tools regularly",
]

MODEL_CAP = 10
WORKFLOW_CAP = 10.0
PROBLEM_CAP = 5
PARTIAL_TASK_WEIGHT = 0.5

# --- fixed values: bands, groups, quadrants ----------------------------------
USAGE_BAND_EDGES = [25, 50, 75]
USAGE_BANDS = [
    "Low (0-25)",
    "Medium-Low (25-50)",
    "Medium-High (50-75)",
    "High (75-100)",
]
EXPERIENCE_GROUPS = [
    "Beginner: 0-1 years",
    "Junior: 2-5 years",
    "Mid-level: 6-10 years",
    "Senior: 11-20 years",
    "Expert: 20+ years",
    "Unknown",
]
QUADRANTS = [
    "Low Usage - Low Trust",
    "Low Usage - High Trust",
    "High Usage - Low Trust",
    "High Usage - High Trust",
]
FOCUS_QUADRANT = "High Usage - Low Trust"

# --- fixed values: model columns ---------------------------------------------
CLUSTER_FEATURES = [
    "UsageScore", "TrustScore", "FrustrationScore",
    "UsageFreq", "AgentDepth", "AIModelCount", "WorkflowIntegration",
    "ProblemCount", "ThreatLevel",
    "DevEnvToolCount", "WorkExpNum",
]
PREDICTORS = [
    "UsageFreq", "AgentDepth", "AIModelCount", "WorkflowIntegration",
    "ProblemCount", "ThreatLevel",
    "DevEnvToolCount", "WorkExpNum",
]
LABEL = "ParadoxLabel"
FOREST_SEEDS = [42, 1337, 2025]

# --- fixed values: display labels --------------------------------------------
USAGE_LABELS = {
    "Yes, I use AI tools daily": "Daily",
    "Yes, I use AI tools weekly": "Weekly",
    "Yes, I use AI tools monthly or infrequently": "Monthly or infrequent",
    "No, but I plan to soon": "Plan to soon",
    "No, and I don't plan to": "Do not plan to",
    "Unknown": "Unknown",
}
ROLE_LABELS = {
    "Developer, AI apps or physical AI": "AI app developer",
    "AI/ML engineer": "AI/ML engineer",
    "Developer, embedded applications or devices": "Embedded developer",
    "Developer, game or graphics": "Game/graphics developer",
}
EXPERIENCE_SHORT = {
    "Beginner: 0-1 years": "0-1 yrs",
    "Junior: 2-5 years": "2-5 yrs",
    "Mid-level: 6-10 years": "6-10 yrs",
    "Senior: 11-20 years": "11-20 yrs",
    "Expert: 20+ years": "20+ yrs",
    "Unknown": "Unknown",
}
FEATURE_LABELS = {
    "WorkExpNum": "Work experience",
    "WorkflowIntegration": "Workflow integration",
    "AIModelCount": "AI model count",
    "DevEnvToolCount": "Dev environment tools",
    "AgentDepth": "Agent usage depth",
    "UsageFreq": "AI usage frequency",
    "ProblemCount": "AI problem count",
    "ThreatLevel": "AI threat perception",
}
WORK_MODE_LABELS = {
    "Remote": "Remote",
    "In-person": "In-person",
    "Unknown": "Unknown",
    "Hybrid (some remote, leans heavy to in-person)": "Hybrid",
    "Hybrid (some in-person, leans heavy to flexibility)": "Hybrid",
    "Your choice (very flexible, you can come in when you want or just as needed)": "Flexible",
}
WORK_MODE_ORDER = ["Remote", "Hybrid", "Flexible", "In-person", "Unknown", "Other"]
# --- end of fixed values -----------------------------------------------------
