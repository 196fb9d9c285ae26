"""Fixed word lists and patterns.

FIXED VALUES: everything in this module must equal what the reviewed
pipeline uses for results to agree (public NLTK / scikit-learn /
wordcloud lists and the pipeline's own keyword sets).  They are kept as
plain text, in their natural order, together.
"""

from __future__ import annotations


def _words(block: str) -> tuple[str, ...]:
    return tuple(block.split())


# --- FIXED VALUES -----------------------------------------------------------

# NLTK English stopwords.  Entries containing an apostrophe are omitted:
# punctuation is stripped before stopword removal, so they never match.
NLTK_ENGLISH = _words("""
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can
will just don should now d ll m o re ve y ain aren couldn didn doesn hadn
hasn haven isn ma mightn mustn needn shan shouldn wasn weren won wouldn
""")

# scikit-learn ``stop_words='english'`` list (used by the n-gram and
# clustering vectorizers).
SKLEARN_ENGLISH = _words("""
a about above across after afterwards again against all almost alone along
already also although always am among amongst amoungst amount an and another
any anyhow anyone anything anyway anywhere are around as at back be became
because become becomes becoming been before beforehand behind being below
beside besides between beyond bill both bottom but by call can cannot cant co
con could couldnt cry de describe detail do done down due during each eg
eight either eleven else elsewhere empty enough etc even ever every everyone
everything everywhere except few fifteen fifty fill find fire first five for
former formerly forty found four from front full further get give go had has
hasnt have he hence her here hereafter hereby herein hereupon hers herself him
himself his how however hundred i ie if in inc indeed interest into is it its
itself keep last latter latterly least less ltd made many may me meanwhile
might mill mine more moreover most mostly move much must my myself name
namely neither never nevertheless next nine no nobody none noone nor not
nothing now nowhere of off often on once one only onto or other others
otherwise our ours ourselves out over own part per perhaps please put rather
re same see seem seemed seeming seems serious several she should show side
since sincere six sixty so some somehow someone something sometime sometimes
somewhere still such system take ten than that the their them themselves then
thence there thereafter thereby therefore therein thereupon these they thick
thin third this those though three through throughout thru thus to together
too top toward towards twelve twenty two un under until up upon us very via
was we well were what whatever when whence whenever where whereafter whereas
whereby wherein whereupon wherever whether which while whither who whoever
whole whom whose why will with within without would yet you your yours
yourself yourselves
""")

# wordcloud's default STOPWORDS (word-frequency table behind the word cloud).
WORDCLOUD_STOPWORDS = _words("""
a about above after again against all also am an and any are aren't as at be
because been before being below between both but by can can't cannot com
could couldn't did didn't do does doesn't doing don't down during each else
ever few for from further get had hadn't has hasn't have haven't having he
he'd he'll he's hence her here here's hers herself him himself his how how's
however http i i'd i'll i'm i've if in into is isn't it it's its itself just
k let's like me more most mustn't my myself no nor not of off on once only or
other otherwise ought our ours ourselves out over own r same shall shan't she
she'd she'll she's should shouldn't since so some such than that that's the
their theirs them themselves then there there's therefore these they they'd
they'll they're they've this those through to too under until up very was
wasn't we we'd we'll we're we've were weren't what what's when when's where
where's which while who who's whom why why's with won't would wouldn't www you
you'd you'll you're you've your yours yourself yourselves
""")

# Tokenizer contraction splits that survive punctuation removal
# (word -> two tokens).
CONTRACTIONS = (
    ("can", "not"),
    ("gim", "me"),
    ("gon", "na"),
    ("got", "ta"),
    ("lem", "me"),
    ("wan", "na"),
)

# Substring keywords of the per-review suggestion flag.
SUGGESTION_SUBSTRINGS = ("please", "fix", "need", "should", "improve", "suggest",
                         "update", "bug", "problem")

# Whole-word patterns of the suggestion-sentence extractor.
SUGGESTION_PHRASES = ("should", "need to", "needs", "must", "please", "add", "fix",
                      "improve", "make it", "would be better", "hope you", "try to")

# Sentence delimiters of the extractor and the join separator.
SENTENCE_DELIMITERS = ".!?"
SUGGESTION_JOIN = " | "

# Devanagari block (reviews in this script are skipped).
DEVANAGARI = ("ऀ", "ॿ")

# Label normalization applied after upper-casing.
LABEL_FIXUPS = (("POS", "POSITIVE"), ("NEG", "NEGATIVE"), ("NEGATIVEATIVE", "NEGATIVE"))

# Rating thresholds: above -> positive, below -> negative, equal -> neutral.
NEUTRAL_RATING = 3

# --- end of fixed values ----------------------------------------------------
