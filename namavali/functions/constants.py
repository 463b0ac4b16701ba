"""Word lists, tables and patterns that results depend on, in their order."""

# Literal replacements for common recognition errors, applied one after the other.
OCR_CORRECTIONS = (
    ("नाच", "नाव"),
    ("नाब", "नाव"),
    ("यंडिलांचे", "वडिलांचे"),
    ("यडिलांचे", "वडिलांचे"),
    ("चडिलांचे", "वडिलांचे"),
    ("बडिलांचे", "वडिलांचे"),
    ("पत्तीचे", "पतीचे"),
    ("पततीचे", "पतीचे"),
    ("आणणाप्या", "आण्णाप्पा"),
    ("आणिणांच्या", "आण्णाच्या"),
    ("नांव", "नाव"),
    ("ara:", "नाव :"),
    ("aa:", "नाव :"),
    ("att", ""),
    ("Fart", ""),
    ("Fert:", "लिंग :"),
    ("fem:", "लिंग :"),
    ("feat:", "लिंग :"),
    ("fear", "महिला"),
    ("mare", "महिला"),
    ("ag:", "वय :"),
    ("चय :", "वय :"),
    ("बय :", "वय :"),
    ("चे नाव:", "वडिलांचे नाव:"),
)

# Names with a known correct form.
NAME_CORRECTIONS = (
    ("हणमंत", "हनुमंत"),
    ("हणमंता", "हनुमंत"),
    ("हणमाण्णा", "हनुमान्ना"),
    ("हृणमाण्णा", "हनुमान्ना"),
    ("किंरण", "किरण"),
    ("अजिंत", "अजित"),
    ("रंबिराज", "रणबीरराज"),
    ("रंबिंद्र", "रवींद्र"),
    ("सोम्लिंग", "सोमलिंग"),
    ("अनित्ता", "अनिता"),
    ("अनित्रा", "अनिता"),
    ("शशिक्तांत", "शशिकांत"),
    ("सांगेता", "संगीता"),
    ("माथुरी", "माधुरी"),
    ("शितल", "शीतल"),
    ("पोर्णिमा", "पूर्णिमा"),
    ("भींमा", "भीमा"),
    ("निल्लास", "निलास"),
    ("मोहून", "मोहन"),
    ("जवश्री", "जयश्री"),
    ("जवकुमार", "जयकुमार"),
    ("चूनुस", "युनुस"),
    ("पुस्तफा", "मुस्तफा"),
    ("जुयेर", "जुबेर"),
    ("रॉफेक", "राफिक"),
    ("शौकत्त", "शौकत"),
    ("यशवंत्त", "यशवंत"),
    ("जयवंत्त", "जयवंत"),
    ("हणमंत्त", "हनुमंत"),
)

# Labels in the order in which they are tried, and phrases of lines that hold no names.
LABELS = ("पतीचे", "वडिलांचे", "पत्नीचे", "आईचे", "नाव", "नाब")
SKIP_PHRASES = ("घर क्रमाक", "वय :", "लिंग :", "छायाचित्र", "उपलब्ध", "यादी भाग", "दिनांकास", "विधानसभा", "विभाग क्रमांक")

# Endings that a relation's label leaves on the name before it, each removed once, in this order.
LABEL_ENDINGS = ("वडिलांचें", "वडिलांचे", "वडिलां", "डेलांचे", "पती", "नाव", "आई")

# Words that are a label alone, and words that begin a heading.
LABEL_WORDS = "नाव|पतीचे|वडिलांचे|आईचे|पत्नीचे|बडिलांचे"
HEADING_WORDS = "विधानसभा|मतदारसंघ|क्रमांक|सांगली|महाराष्ट्र|छायाचित्र"

# Remains of badly read text.
ARTIFACTS = "eae|BT|donee|HATTERAS|HSS|decor|Fife|Orde|Sea|Bett|Fretar|ord|ga|Sta"

# Signs that cannot begin a word; the long a is not among them.
DEPENDENT_SIGNS = "िीुूृॄॅेैॉोौंः्ँ"

# The comparison key lengthens four vowel signs, takes the dots off ten composed letters, and deletes the
# nasal signs and the dot below. Written as escapes, since editors take composed letters apart.
KEY_FROM = "\u093f\u0941\u0947\u094b\u0929\u0931\u0934\u0958\u0959\u095a\u095b\u095c\u095d\u095e\u095f\u0902\u0901\u093c"
KEY_TO = "\u0940\u0942\u0948\u094c\u0928\u0930\u0933\u0915\u0916\u0917\u091c\u0921\u0922\u092b\u092f"

# ITRANS spelling.
ITRANS_CONSONANTS = (
    ("क", "k"), ("ख", "kh"), ("ग", "g"), ("घ", "gh"), ("ङ", "~N"), ("च", "ch"), ("छ", "Ch"), ("ज", "j"), ("झ", "jh"), ("ञ", "~n"),
    ("ट", "T"), ("ठ", "Th"), ("ड", "D"), ("ढ", "Dh"), ("ण", "N"), ("त", "t"), ("थ", "th"), ("द", "d"), ("ध", "dh"), ("न", "n"),
    ("प", "p"), ("फ", "ph"), ("ब", "b"), ("भ", "bh"), ("म", "m"), ("य", "y"), ("र", "r"), ("ल", "l"), ("व", "v"),
    ("श", "sh"), ("ष", "Sh"), ("स", "s"), ("ह", "h"), ("ळ", "L"),
)
ITRANS_OTHERS = (
    ("अ", "a"), ("आ", "A"), ("इ", "i"), ("ई", "I"), ("उ", "u"), ("ऊ", "U"), ("ऋ", "RRi"), ("ए", "e"), ("ऐ", "ai"), ("ओ", "o"), ("औ", "au"),
    ("ा", "A"), ("ि", "i"), ("ी", "I"), ("ु", "u"), ("ू", "U"), ("ृ", "RRi"), ("े", "e"), ("ै", "ai"), ("ो", "o"), ("ौ", "au"),
    ("ं", "M"), ("ः", "H"), ("ँ", ".N"), ("्", ""),
)
