"""Fixed values of the analytics.

as they are; operators take them as parameter defaults.
"""

# ---- fixed values -------------------------------------------------------------------------
REVERT_WORD = "Revert"                        # B6: streak word (messages must start with it)
UNKNOWN_EXTENSION = "unknown"                 # B2: no name or no extension
DAY_FORMAT = "dd-MM-yyyy"                     # C5, C7: day label
LARGE_ADDITIONS = 20                          # C1: at least this many additions
LARGE_DELETIONS = 30                          # C2: more than this many deletions
COUNTED_EXTENSIONS = ("java", "scala")        # C3
STATUS_EXTENSIONS = ("js", "py")              # C4
SMALL_COMMIT_MAX = 20                         # C6: 0..20 total changes is "small", else "large"
SIZE_WINDOW = "48 hours"                      # C6: window length
SIZE_SLIDE = "12 hours"                       # C6: window slide
SUMMARY_MIN_COMMITS = 20                      # C7: keep days with more commits than this
SUMMARY_MAX_COMMITTERS = 2                    # C7: ... and at most this many committers
GEO_BEFORE = "1 hour"                         # C8: geo event at most this long before the commit
GEO_AFTER = "30 minutes"                      # C8: ... or this long after it
JAVA_SUFFIX = ".java"                         # C8
ADDED_REMOVED_WITHIN = "1 day"                # C9
JS_SUFFIX = ".js"                             # D2
TOP_FORMATS = 5                               # D5
MISSING_FILE_TEXT = "File does not exist"     # E2
REQUEST_WORD = "GET"                          # E3
FIRST_REQUESTS = 3                            # E3
POST_METHOD = "POST"                          # E4-E6
TOP_WORDS = 10                                # E8
FIRST_SENTENCES = 7                           # E9
LONE_LOWER_I = "i"                            # E10: the word replaced ...
UPPER_I = "I"                                 # E10: ... by this
FIRST_ABOVE_N = 10                            # F14: first n values ...
FIRST_ABOVE_X = 25                            # F14: ... greater than x
PASS_AVERAGE = 5.75                           # F15: minimum average grade
PASS_MIN_GRADE = 4                            # F15: no grade below this
FIZZ_DIVISOR = 3                              # F17
BUZZ_DIVISOR = 5                              # F17
FIZZ, BUZZ, FIZZBUZZ = "Fizz", "Buzz", "FizzBuzz"  # F17 labels
