"""Word lists that several operators share."""

# Frequent words of some languages.
COMMON = {
    "en": """the of and to in is it that for you with on are this be not from your have can will which at by an or as we if but there after our they how
        what does do my was any who""",
    "de": """der die das und ist nicht ein eine einen einem einer zu den dem mit von für auf sich sie ich wir es auch bei aus nach wie was wird werden sind
        kann können haben ihr ihre bitte oder aber im am zum zur des wenn vor nur man""",
    "fr": """le la les de des du et est un une que qui dans pour pas sur au aux avec ce cette vous je nous il elle par plus ne se sont votre vos ou mais en
        si été à où comme on d l qu n""",
    "es": """el la los las de del y es un una que en no por para con se su sus al lo como más pero está este esta le usted puede ha o si nos qué cuando sin
        entre hasta desde el yo mi""",
    "pt": """o a os as de do da dos das e é um uma que em no na não por para com se seu sua ao à como mais mas está este esta pode ou são dias até você junte
        abra""",
    "it": """il lo la gli le il di del della dei e è un una che in non per con si suo sua al alla come più ma questo questa può o sono dopo anche fino nella
        aggiunga apra""",
    "nl": """de het een en is van in op te dat niet met voor zijn u uw aan er bij of maar kunt kan wij we na als naar om deze dit tot nog weer heeft ook""",
    "pl": """i w na z nie się że do jest to po za o od dla przez pan pani może proszę czy jak jego jej są lub albo ten ta już tylko można dni zwrot kwota""",
    "sv": """och att det en ett är på som av för med inte den till har vi du kan från eller men om efter när så""",
    "cs": """a se na je že v s z do to o za po jak pro by ale nebo není můžete prosím vám si""",
    "tr": """ve bir bu için ile da de ne olarak daha çok gibi en sonra kadar var değil lütfen""",
}
COMMON = {language: frozenset(words.split()) for language, words in COMMON.items()}
