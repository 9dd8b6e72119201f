"""Domains and subsections of scores, by tables (fixed values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skein.functions.rules import first_keyword, first_mapped

# The tables below are fixed values.
ORGAN_DOMAINS = {
    "cardiology": "Cardiology",
    "neurology": "Neuro_Psychiatry", "psychiatry": "Neuro_Psychiatry",
    "hematology": "Hematology",
    "immunology": "Immunology", "rheumatology": "Immunology", "dermatology": "Immunology",
    "endocrinology": "Endocrinology",
    "oncology": "Oncology", "breast": "Oncology", "gynecology": "Oncology",
    "nephrology": "Nephrology_Urology", "urology": "Nephrology_Urology",
    "gastroenterology": "Gastro_Hepatology", "hepatology": "Gastro_Hepatology",
    "pulmonology": "Pulmonology",
    "musculoskeletal": "Musculoskeletal", "orthopedics": "Musculoskeletal",
    "ophthalmology": "Ophthalmology",
    "dentistry": None,  # known, and of no domain here: the next organ system decides
    "andrology": "Nephrology_Urology",
}
CATEGORY_DOMAINS = {
    "Cardiovascular disease": "Cardiology", "Cardiovascular measurement": "Cardiology",
    "Cancer": "Oncology",
    "Immune system disorder": "Immunology", "Inflammatory measurement": "Immunology",
    "Neurological disorder": "Neuro_Psychiatry",
    "Metabolic disorder": "Endocrinology", "Lipid or lipoprotein measurement": "Endocrinology",
    "Hematological measurement": "Hematology",
    "Body measurement": "Endocrinology",
    "Digestive system disorder": "Gastro_Hepatology",
    "Other measurement": None, "Other disease": None, "Other trait": None, "Biological process": None,
}
FAMILY_DOMAINS = {
    "Coronary_Artery_Disease": "Cardiology", "Heart_Failure": "Cardiology", "Atrial_Fibrillation": "Cardiology", "Stroke": "Cardiology",
    "Hypertension": "Cardiology", "Peripheral_Artery_Disease": "Cardiology", "Venous_Thromboembolism": "Cardiology", "Aortic_Aneurysm": "Cardiology",
    "Breast_Cancer": "Oncology", "Prostate_Cancer": "Oncology", "Colorectal_Cancer": "Oncology", "Lung_Cancer": "Oncology",
    "Ovarian_Cancer": "Oncology", "Melanoma": "Oncology", "Bladder_Cancer": "Oncology", "Kidney_Cancer": "Oncology",
    "Pancreatic_Cancer": "Oncology", "Endometrial_Cancer": "Oncology", "Thyroid_Cancer": "Oncology", "Glioma": "Oncology",
    "Lymphoma": "Oncology", "Testicular_Cancer": "Oncology",
    "Type_2_Diabetes": "Endocrinology", "Type_1_Diabetes": "Endocrinology", "Thyroid_Disease": "Endocrinology", "Obesity": "Endocrinology",
    "Celiac_Disease": "Immunology", "Crohns_Disease": "Immunology", "Ulcerative_Colitis": "Immunology", "IBD": "Immunology",
    "Asthma": "Immunology", "Atopic_Dermatitis": "Immunology", "Psoriasis": "Immunology", "Rheumatoid_Arthritis": "Immunology",
    "Lupus": "Immunology", "Ankylosing_Spondylitis": "Immunology", "Multiple_Sclerosis": "Immunology", "Allergy": "Immunology",
    "Parkinsons_Disease": "Neuro_Psychiatry", "Alzheimers_Disease": "Neuro_Psychiatry", "Schizophrenia": "Neuro_Psychiatry", "Bipolar_Disorder": "Neuro_Psychiatry",
    "Depression": "Neuro_Psychiatry", "Epilepsy": "Neuro_Psychiatry", "ADHD": "Neuro_Psychiatry", "Autism": "Neuro_Psychiatry",
    "Anxiety": "Neuro_Psychiatry", "ALS": "Neuro_Psychiatry",
    "CKD": "Nephrology_Urology", "Kidney_Stones": "Nephrology_Urology",
    "Gout": "Musculoskeletal", "Osteoporosis": "Musculoskeletal",
    "COPD": "Pulmonology", "Sleep_Apnea": "Pulmonology",
    "NAFLD": "Gastro_Hepatology", "Cirrhosis": "Gastro_Hepatology",
    "Glaucoma": "Ophthalmology", "AMD": "Ophthalmology",
}
DOMAIN_ORDER = ("Cardiology", "Neuro_Psychiatry", "Hematology", "Immunology", "Endocrinology", "Oncology", "Nephrology_Urology", "Gastro_Hepatology", "Pulmonology", "Musculoskeletal", "Ophthalmology")
DOMAIN_COLORS = {
    "Cardiology": "#e53935", "Neuro_Psychiatry": "#8e24aa", "Hematology": "#ec407a", "Immunology": "#1e88e5", "Endocrinology": "#ff7043", "Oncology": "#ffa726",
    "Nephrology_Urology": "#66bb6a", "Gastro_Hepatology": "#26a69a", "Pulmonology": "#42a5f5", "Musculoskeletal": "#ffb74d", "Ophthalmology": "#78909c", "Other": "#9e9e9e",
}
MONITORS = {
    "Cardiology": ("LDL cholesterol", "Triglycerides", "Blood pressure", "Resting ECG"),
    "Endocrinology": ("HbA1c", "Fasting glucose", "TSH", "BMI"),
    "Immunology": ("CRP", "tTG-IgA (celiac screen)", "IgE (allergy)", "ESR"),
    "Neuro_Psychiatry": ("Cognitive screening if symptomatic", "PHQ-9 (depression)"),
    "Oncology": ("Age-appropriate cancer screening", "PSA (males >50)"),
    "Nephrology_Urology": ("eGFR", "Creatinine", "Urine albumin"),
    "Gastro_Hepatology": ("ALT", "AST", "Bilirubin", "Stool calprotectin"),
    "Pulmonology": ("Spirometry (FEV1/FVC)", "Peak flow"),
    "Hematology": ("CBC with differential", "Ferritin"),
    "Musculoskeletal": ("DEXA bone density", "Uric acid", "Vitamin D"),
    "Ophthalmology": ("Intraocular pressure", "Fundoscopy"),
}
LANDSCAPES = {
    "biomarker_lab": "biomarkers", "imaging_structure": "brain_imaging", "quantitative_physiology": "physiology",
    "behavior_lifestyle": "behavioral", "anthropometric": "anthropometric", "longevity_resilience": "longevity",
}
LAB_CATEGORIES = {"Lipid or lipoprotein measurement": "Lipids", "Hematological measurement": "Blood_Cells", "Cardiovascular measurement": "Cardiac_Markers", "Inflammatory measurement": "Inflammatory"}
IMAGING_ORGANS = {"neurology": "Brain_Structure", "cardiology": "Cardiac_Imaging", "ophthalmology": "Eye_Imaging", "hepatology": "Liver_Imaging"}
PHYSIOLOGY_ORGANS = {"hematology": "Blood_Function", "cardiology": "Cardiac_Function", "orthopedics": "Bone_Density", "pulmonology": "Lung_Function", "ophthalmology": "Vision", "musculoskeletal": "Bone_Density"}
#: Keyword to subsection; the first in order counts.
BEHAVIOR_KEYWORDS = (
    ("smok", "Smoking"), ("tobacco", "Smoking"), ("cigarette", "Smoking"),
    ("alcohol", "Alcohol"), ("drink", "Alcohol"),
    ("sleep", "Sleep"), ("chronotype", "Sleep"), ("insomnia", "Sleep"), ("snor", "Sleep"),
    ("education", "Education_Cognition"), ("intelligence", "Education_Cognition"),
    ("neurotic", "Personality"), ("depress", "Personality"), ("worry", "Personality"), ("happiness", "Personality"), ("loneli", "Personality"), ("anxiet", "Personality"),
    ("cannabis", "Substance"), ("caffein", "Substance"), ("coffee", "Substance"), ("tea ", "Substance"),
    ("menarche", "Reproductive"), ("menopaus", "Reproductive"), ("menstrual", "Reproductive"), ("children", "Reproductive"), ("sexual", "Reproductive"), ("birth", "Reproductive"),
    ("hair", "Appearance"), ("bald", "Appearance"), ("tann", "Appearance"), ("sunburn", "Appearance"),
    ("physical", "Activity"), ("walk", "Activity"), ("exercise", "Activity"),
    ("diet", "Diet"), ("fruit", "Diet"), ("vegetable", "Diet"), ("cereal", "Diet"), ("meat", "Diet"), ("fish", "Diet"), ("sugar", "Diet"), ("milk", "Diet"),
)
BODY_KEYWORDS = (
    ("bmi", "BMI_Obesity"), ("obes", "BMI_Obesity"), ("body mass", "BMI_Obesity"),
    ("height", "Height"), ("sitting height", "Height"),
    ("waist", "Body_Composition"), ("hip", "Body_Composition"), ("fat", "Body_Composition"), ("lean", "Body_Composition"), ("water", "Body_Composition"), ("ankle", "Body_Composition"),
)


def domain(family: Column, organs: Column, categories: Column, phenotype: Column) -> Column:
    """By family, else the first organ system that has one, else the first category, else the phenotype's default."""
    by_family = first_mapped(F.array(family), FAMILY_DOMAINS)
    default = F.when(phenotype == "imaging_structure", "Neuro_Psychiatry").when(phenotype == "anthropometric", "Endocrinology")
    return F.coalesce(by_family, first_mapped(organs, ORGAN_DOMAINS), first_mapped(categories, CATEGORY_DOMAINS), default)


def subsection(phenotype: Column, label: Column, organs: Column, categories: Column) -> Column:
    """The part of its phenotype's landscape that a score belongs to."""
    text = F.coalesce(F.lower(label), F.lit(""))
    return (
        F.when(phenotype == "biomarker_lab", F.coalesce(first_mapped(categories, LAB_CATEGORIES), F.lit("Other_Lab")))
        .when(phenotype == "imaging_structure", F.coalesce(first_mapped(organs, IMAGING_ORGANS), F.lit("Brain_Structure")))
        .when(phenotype == "quantitative_physiology", F.coalesce(first_mapped(organs, PHYSIOLOGY_ORGANS), F.lit("Other_Physiology")))
        .when(phenotype == "behavior_lifestyle", first_keyword(text, list(BEHAVIOR_KEYWORDS), "Other_Behavioral"))
        .when(phenotype == "anthropometric", first_keyword(text, list(BODY_KEYWORDS), "Other_Body"))
    )
