"""Word lists, character maps and patterns that results depend on.

Pattern texts are spelled so that Java and RE2 read them alike: W is the set of
blanks, and case is ignored with ``(?iu)`` in Java and ``(?i)`` in RE2.
"""

# Blanks, as Unicode white space.
W = r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NOT_W = r"[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
# Digits, with superscripts and numbers in circles.
DIGIT = r"[\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}]"
# The Greek blocks.
GREEK = r"[\x{370}-\x{3ff}\x{1f00}-\x{1fff}]"
# Punctuation stripped from the edges of words.
EDGE = ".,;:!?\"'()«»[]{} -—"

# Symbol variants and the Greek letters they stand for.
SYMBOLS_FROM = "ßµϐϑϒϕϖϰϱϴϵ"
SYMBOLS_TO = "βμβθΥφπκρΘε"
# Latin letters and the Greek letters they look like.
LATIN = "ABEHIKMNOPTXYZaeiopvxyw"
GREEK_LOOK = "ΑΒΕΗΙΚΜΝΟΡΤΧΥΖαειορνχυω"
# Accented letters and their plain forms.
ACCENTED = "άέήίόύώΐΰϊϋΆΈΉΊΌΎΏΪΫ"
PLAIN = "αεηιουωιυιυΑΕΗΙΟΥΩΙΥ"
# Letters that carry the stress mark (no bare dieresis).
STRESSED = "άέήίόύώΐΰΆΈΉΊΌΎΏ"
# Vowels, and pairs of vowels that are one sound.
VOWELS = "αειουηωάέήίόύώϊϋΐΰΑΕΙΟΥΗΩΆΈΉΊΌΎΏΪΫ"
DIGRAPHS = "αι|ει|οι|ου|υι|αυ|ευ|άι|έι|όι"
# Words that never take a stress mark.
MONOSYLLABLES = (
    "και για του των τους μου σου της τον την το τα οι μα να θα δε δεν μη μην πως που σε με μια δυο ναι ποιος ποια ποιο αν "
    "κι ως σαν προς στο στη στην στα στους στις μας σας"
).split()

# Shapes of links, time cues and addresses.
URL = rf"https?://{NOT_W}+|www\.{NOT_W}+"
CUE = rf"\p{{Nd}}{{1,2}}:\p{{Nd}}{{2}}:\p{{Nd}}{{2}}[,\.]\p{{Nd}}{{3}}{W}*-->{W}*\p{{Nd}}{{1,2}}:\p{{Nd}}{{2}}:\p{{Nd}}{{2}}[,\.]\p{{Nd}}{{3}}"
ADDRESS = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}"
# Stems of subtitle credits.
CREDITS = (
    "υπότιτλοι|μετάφραση|συγχρονισμός|επιμέλεια|διορθώσεις|απόδοση|σχολιασμός|"
    "subtitles|sync|ripped|encoded|downloaded|opensubtitles|addic7ed|podnapisi|tvsubtitles"
)
# Administrative, legal and web phrases.
BOILERPLATE = (
    r"εκλογικό τμήμα|εκλογικής περιφέρειας|δημοτικής ενότητας|δικηγορικός σύλλογος|"
    rf"αρ\.?{W}*πρωτ|α\.δ\.τ|α\.φ\.μ|φ\.ε\.κ|διαύγεια|αδα:|αριθμ\.{W}*πραξ|"
    r"ημερομηνία δημοσίευσης|τελευταία ενημέρωση|συντάχθηκε:|όροι χρήσης|"
    rf"πνευματικά δικαιώματα|cookies?|all rights reserved|τηλ:{W}*\p{{Nd}}|φαξ:{W}*\p{{Nd}}|"
    rf"τ\.κ\.{W}*\p{{Nd}}|ονοματεπώνυμο|επιτυχόντες|αποφασίζουμε|διοικητικό συμβούλιο|"
    r"πρωτοδικεί|ειρηνοδικεί|συμβολαιογράφ|δελτίο τύπου|διάμετρος/διαδρομή"
)
# Names of the months in the genitive.
MONTHS = "Ιανουαρίου|Φεβρουαρίου|Μαρτίου|Απριλίου|Μαΐου|Ιουνίου|Ιουλίου|Αυγούστου|Σεπτεμβρίου|Οκτωβρίου|Νοεμβρίου|Δεκεμβρίου"
# The start of an almanac entry.
ALMANAC = rf"^{W}*(?:\p{{Nd}}{{1,2}}{W}+(?:{MONTHS})|\p{{Nd}}{{3,4}}){W}*[-–—:]"
# Encyclopedia navigation phrases.
NAVIGATION = (
    "μπορεί να αναφέρεται|δείτε επίσης|εξωτερικοί σύνδεσμοι|βιβλιογραφία|"
    "παραπομπές|σχετικά άρθρα|κύριο λήμμα|σημειώσεις και παραπομπές"
)
# A calendar sentence, bracketed spans and sound notes, speakers and list numbers at the start of a line.
CALENDAR = "ημέρα του έτους κατά το (?:Γρηγοριανό|Ιουλιανό) ημερολόγιο"
BRACKETED = r"\[[^\n]*?\]|\([^\n]*?\)|<[^\n]*?>|\{[^\n]*?\}|♪[^\n]*?♪|♫[^\n]*?♫"
SPEAKER = rf"^{W}*(?:[-–—»>]+{W}*)?(?:(?:[Α-ΩΆΈΉΊΌΎΏΪΫA-Z0-9_]|{W}){{2,20}}:|[-–—»>]+){W}*"
NUMBERING = rf"^{W}*(?:\p{{Nd}}{{1,2}}[.)\]]|\([0-9a-zA-Z]\)){W}+"
# Letters whose neighbourhood with ASCII letters makes a word mixed.
GREEK_LETTER = "α-ωάέήίόύώϊϋΐΰΑ-ΩΆΈΉΊΌΎΏΪΫ"
MIXED = f"[{GREEK_LETTER}][a-zA-Z]|[a-zA-Z][{GREEK_LETTER}]"
# The entities that the bounded unescape knows; the ampersand goes last.
ENTITIES = [("&quot;", '"'), ("&#34;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&laquo;", "«"), ("&raquo;", "»"), ("&hellip;", "…"), ("&ndash;", "–"), ("&mdash;", "—"), ("&amp;", "&")]

# Each key of the Greek layout and its neighbours.
ADJACENT = {
    "α": "σζςεδ", "σ": "αδερχζ", "δ": "σφρτχψ", "φ": "δγτυψω", "γ": "φηυθωβ",
    "η": "γξθιβν", "ξ": "ηκιονμ", "κ": "ξλοπμ", "λ": "κπο", "ς": "αεσ",
    "ε": "ςρασδ", "ρ": "ετσδφ", "τ": "ρυδφγ", "υ": "τθφγη", "θ": "υιγηξ",
    "ι": "θοηξκ", "ο": "ιπξκλ", "π": "οκλ", "ζ": "ασχ", "χ": "ζψσδ",
    "ψ": "χωδφ", "ω": "ψβφγ", "β": "ωνγη", "ν": "βμηξ", "μ": "νξκ",
}
# Spellings of one sound, from and to.
HOMOPHONES = [
    ("ει", "ι"), ("ι", "ει"), ("οι", "ι"), ("ι", "οι"), ("η", "ι"), ("ι", "η"), ("υ", "ι"), ("ι", "υ"),
    ("ει", "η"), ("η", "ει"), ("οι", "η"), ("η", "οι"), ("υ", "η"), ("η", "υ"), ("αι", "ε"), ("ε", "αι"), ("ο", "ω"), ("ω", "ο"),
]
# Words that seed the vocabulary first.
PRIORITY_WORDS = (
    "καλημέρα καλημερα καλησπέρα καλησπερα καληνύχτα καληνυχτα παρακαλώ παρακαλω ευχαριστώ ευχαριστω συγγνώμη συγγνωμη "
    "οικογένεια οικογενεια αυτοκίνητο αυτοκινητο τηλέφωνο τηλεφωνο άνθρωπος ανθρωπος παιδιά παιδια σπίτι σπιτι δρόμο δρομο "
    "θέλω θελω είμαι ειμαι είσαι εισαι είμαστε ειμαστε"
).split()
# Probes of a trained vocabulary (each with a space after it).
PROBE_WORDS = (
    "καλημέρα καλημερα καλησπέρα καλησπερα παρακαλώ παρακαλω ευχαριστώ ευχαριστω παιδιά παιδια άνθρωπος ανθρωπος "
    "οικογένεια αυτοκίνητο τηλέφωνο τηλεφωνο θέλω θελω είμαι ειμαι σπίτι σπιτι δρόμο δρομο"
).split()
# Control pieces of correction prompts.
BAD, GOOD, END = "<XBU>", "<XBC>", "<XEC>"
# Names of model tensors, and of those in each layer.
TENSORS = {"model.embed_tokens.weight": "token_embd.weight", "model.norm.weight": "output_norm.weight", "lm_head.weight": "output.weight"}
LAYER_TENSORS = {
    "self_attn.q_proj.weight": "attn_q.weight", "self_attn.k_proj.weight": "attn_k.weight", "self_attn.v_proj.weight": "attn_v.weight",
    "self_attn.o_proj.weight": "attn_output.weight", "mlp.gate_proj.weight": "ffn_gate.weight", "mlp.up_proj.weight": "ffn_up.weight",
    "mlp.down_proj.weight": "ffn_down.weight", "input_layernorm.weight": "attn_norm.weight", "post_attention_layernorm.weight": "ffn_norm.weight",
}
# Stems of parameter names without weight decay.
UNDECAYED = "bias|layer_norm|layernorm|rms_norm"

#: Sentences of our own that stand in where no source gives a line.
FALLBACK = [
    "Το πρωί άνοιξε το παράθυρο και μπήκε καθαρός αέρας.", "Ποιος άφησε τα κλειδιά πάνω στο τραπέζι;", "Αύριο θα ανέβουμε μαζί στο βουνό.", "Η γάτα κοιμάται δίπλα στη σόμπα.",
    "Μου αρέσει να διαβάζω όταν βρέχει.", "Θα σε περιμένω έξω από τον σταθμό.", "Το ψωμί βγήκε μόλις από τον φούρνο.", "Δεν βρήκα κανέναν στο γραφείο σήμερα.",
    "Πες μου αν χρειάζεσαι βοήθεια.", "Το καράβι φεύγει νωρίς το απόγευμα.", "Οι μαθητές έγραψαν μια μικρή ιστορία.", "Πόσο κοστίζει αυτό το βιβλίο;",
    "Έχασα το λεωφορείο και ήρθα με τα πόδια.", "Η συνάντηση αναβλήθηκε για την άλλη εβδομάδα.", "Φέρε μου λίγο νερό, σε παρακαλώ.", "Το χωριό μας έχει μια παλιά βρύση.",
    "Κάθε καλοκαίρι κολυμπάμε στην ίδια ακτή.", "Νομίζω ότι έχεις δίκιο.", "Το φαγητό ήταν πολύ νόστιμο, ευχαριστούμε.", "Γιατί δεν μου το είπες νωρίτερα;",
]
#: Control pieces of the vocabulary, beside the usual ones.
CONTROL = [BAD, GOOD, END]
